"""The three player slots of a play-by-play row as rows."""

from pyspark.sql import DataFrame, functions as F

from rimline.functions.play import is_player, whole_id


def unpivot_players(pbp: DataFrame, keep: list[str]) -> DataFrame:
    """One row per slot, tagged 1, 2 or 3 as an integer; ``keep`` names the columns carried along."""
    slots = ", ".join(
        f"{n}, cast(PLAYER{n}_ID as bigint), cast(PLAYER{n}_NAME as string), "
        f"cast(PLAYER{n}_TEAM_ID as double), cast(PERSON{n}TYPE as double)"
        for n in (1, 2, 3)
    )
    names = "participant_slot, player_id, player_name, player_team_id, person_type"
    return pbp.selectExpr(*keep, f"stack(3, {slots}) as ({names})")


def real_participants(slots: DataFrame) -> DataFrame:
    """Slots that hold a real player; their role is not decoded and stays NULL."""
    return slots.where(is_player(F.col("person_type"))).select(
        *[c for c in slots.columns if c not in ("player_team_id", "person_type")],
        whole_id(F.col("player_team_id")).alias("team_id"),
        F.lit(None).cast("string").alias("role"),
    )
