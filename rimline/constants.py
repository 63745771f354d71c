"""Fixed values of the domain."""

# Court, in feet, origin at a corner; one hoop centre per half.
COURT_LENGTH = 94.0
COURT_WIDTH = 50.0
HALF_LENGTH = 47.0
HOOPS = ((5.25, 25.0), (88.75, 25.0))
HOOP_Y = 25.0
CORNER_Y = 22.0
CORNER_THREE_FT = 22.0
ARC_THREE_FT = 23.75

# Trajectory search.
RIM_Z_LOW = 8.0
RIM_Z_HIGH = 12.0
RELEASE_LOOKBACK_S = 2.5

# Identifiers.
BALL_ID = -1
GAME_ID_LENGTH = 10

# Play-by-play event codes.
EVENT_TYPES = {
    1: "MADE_SHOT",
    2: "MISSED_SHOT",
    3: "FREE_THROW",
    4: "REBOUND",
    5: "TURNOVER",
    6: "FOUL",
    7: "VIOLATION",
    8: "SUBSTITUTION",
    9: "TIMEOUT",
    10: "JUMP_BALL",
    11: "EJECTION",
    12: "PERIOD_BEGIN",
    13: "PERIOD_END",
    18: "INSTANT_REPLAY",
}
OTHER_EVENT = "OTHER"
MADE_CODE = 1
MISSED_CODE = 2

# What the person slots of a play-by-play row hold.
PLAYER_TYPES = (4, 5)
TEAM_TYPES = (2, 3)

# The one season that is served, as a calendar for the jobs that need one.
SEASONS = ((2015, "2015-16", "2015-10-27", "2016-06-19"),)
