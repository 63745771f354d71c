"""URL filters: rules of hosts and paths first, gradient-boosted trees over lexical features for all other URLs.

Labelled URLs train the trees; in the query these are the URLs that a rule judges. Features are the length of the URL, of its
host and path, depth, digit share, entropy of the host's characters, parameters, labels and hyphens of the host, and suffix
statistics: smoothed shares of blocked URLs among the labelled ones with the same last label of the host, the same last two, the same
ending of the path and the same first directory. Each tree is grown level by level: Spark sums the logistic loss's slopes
and curvatures by node, feature and bin over the sample, the driver picks each node's split from these sums (nodes x
features x bins rows), and the finished trees are conditional expressions over the features. All of it is DataFrame functions.

What is bounded: the sample (``SAMPLE`` labelled URLs, those of the least hashes), so at most SAMPLE / SUPPORT suffixes of a kind
have a statistic, which bounds the broadcast table of them. Every URL is judged, whole.

Defined cases: a URL that is null or has no ``://`` has an empty host and path; a host keeps port and user name; a host's
empty labels count as labels; equal URLs are judged equally, whatever their ids; without labelled URLs all verdicts
of the method are ``allow``, with one label only they are that label; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimline.llm.common import cut, table

#: Labelled URLs that the trees are fitted on.
SAMPLE = 20_000
TREES = 10
DEPTH = 3
#: Bins of a feature; their bounds are quantiles of the sample.
BINS = 16
RATE = 0.4
#: Added to the curvature of each leaf.
RIDGE = 1.0
#: Labelled URLs that a leaf, or a suffix with a statistic, must have.
SUPPORT = 20
#: Labelled URLs of the average share that are added to each suffix's.
PRIOR = 10.0
#: Slopes are summed as whole multiples of this, so the order of rows makes no difference.
UNIT = 1 << 20

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict): what the query's contract fixes.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
Rule = tuple[str, str, str]

SIGNS = "abcdefghijklmnopqrstuvwxyz0123456789-."
SUFFIXES = ("last_label", "last_labels", "ending", "directory")
FEATURES = ("length", "host_length", "path_length", "depth", "digit_share", "entropy", "parameters", "labels", "hyphens", *(f"{s}_share" for s in SUFFIXES))


def lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def parsed(urls: DataFrame) -> DataFrame:
    """The rows, whose ``url`` is read, with ``host`` and ``path``."""
    host, path = host_and_path(F.col("url").cast("string"))
    return urls.withColumns({"host": host, "path": path})


def ruled(rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later conditions wrap earlier ones, so the longest stands outermost.
    for host, path, judged in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, judged).otherwise(verdict)
    return rule, verdict


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign)))


def entropy(text: Column) -> Column:
    """Bits a character of a text, over letters, digits, hyphen and point; other characters don't count."""
    counts = F.transform(F.array(*(F.lit(s) for s in SIGNS)), lambda s: (F.length(text) - F.length(F.replace(text, s))).cast("double"))
    size = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
    held = F.aggregate(counts, F.lit(0.0), lambda a, n: a + F.when(n > 0, n * F.log2(n)).otherwise(0.0))
    return F.when(size > 0, F.log2(size) - held / size).otherwise(0.0)


def described(urls: DataFrame) -> DataFrame:
    """Parsed rows with their features, but for the suffixes' shares, and their suffixes."""
    url, host, path = F.coalesce(F.col("url").cast("string"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    return urls.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length(path).cast("double"),
            "depth": _count(path, "/").cast("double"),
            "digit_share": digits / F.greatest(F.length(url), F.lit(1)),
            "entropy": entropy(host),
            "parameters": F.when(query == "", 0.0).otherwise(1.0 + _count(query, "&")),
            "labels": F.when(host == "", 0.0).otherwise(1.0 + _count(host, ".")),
            "hyphens": _count(host, "-").cast("double"),
            "last_label": F.substring_index(host, ".", -1),
            "last_labels": F.substring_index(host, ".", -2),
            "ending": F.regexp_extract(path, r"(\.[A-Za-z0-9]{1,8}|/)$", 1),
            "directory": F.regexp_extract(path, "^/([^/]*)/", 1),
        }
    )


@dataclass(frozen=True)
class Split:
    """Rows with a bin up to ``bin`` of a feature go left. A leaf has no feature."""

    feature: int = -1
    bin: int = -1
    left: Split | None = None
    right: Split | None = None
    value: float = 0.0

    def column(self, goes_left) -> Column:
        if self.feature < 0:
            return F.lit(self.value)
        return F.when(goes_left(self.feature, self.bin), self.left.column(goes_left)).otherwise(self.right.column(goes_left))


@dataclass(frozen=True)
class Model:
    base: float
    cuts: list[list[float]]
    trees: list[Split]
    shares: DataFrame | None
    average: float

    def score(self) -> Column:
        """The log odds of ``block``, over the columns of features."""
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + tree.column(lambda f, b: F.col(FEATURES[f]) <= self.cuts[f][b])
        return total


def with_shares(rows: DataFrame, shares: DataFrame | None, average: float) -> DataFrame:
    """Described rows with the share of each of their suffixes; the average share where that has none."""
    for kind in SUFFIXES:
        name = f"{kind}_share"
        if shares is None:
            rows = rows.withColumn(name, F.lit(average))
            continue
        # The sample bounds this side: a suffix needs SUPPORT of its rows.
        own = F.broadcast(shares.where(F.col("kind") == kind).select(F.col("suffix").alias(kind), F.col("share").alias(name)))
        rows = rows.join(own, kind, "left").withColumn(name, F.coalesce(name, F.lit(average)))
    return rows


def _grown(binned: DataFrame, score: Column, depth: int) -> Split:
    """One tree: each level's best splits by the gain in the loss, from sums by node, feature and bin."""
    chance = 1 / (1 + F.exp(-score))
    slopes = binned.withColumns({"slope": F.round((chance - F.col("blocked")) * UNIT).cast("long"), "curve": F.round(chance * (1 - chance) * UNIT).cast("long")})
    splits: dict[int, tuple[int, int]] = {}
    leaves: dict[int, float] = {}

    def node() -> Column:
        """The number of a row's node: 1 at the root, 2i and 2i + 1 below i."""

        def below(i: int) -> Column:
            if i not in splits:
                return F.lit(i)
            feature, at = splits[i]
            return F.when(F.col("bins")[feature] <= at, below(2 * i)).otherwise(below(2 * i + 1))

        return below(1)

    open_nodes = {1}
    for level in range(depth + 1):
        placed = slopes.select(node().alias("node"), "slope", "curve", "n", F.posexplode("bins").alias("feature", "bin")).where(F.col("node").isin(list(open_nodes)))
        weighed = [F.sum(F.col("n") * F.col(c)).alias(c) for c in ("slope", "curve")]
        sums: dict[int, dict[int, dict[int, tuple]]] = {}
        for r in placed.groupBy("node", "feature", "bin").agg(F.sum("n").alias("n"), *weighed).collect():
            sums.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["slope"] / UNIT, r["curve"] / UNIT, r["n"])
        following: set[int] = set()
        for i in sorted(sums):
            whole = [sum(v[k] for v in sums[i][0].values()) for k in range(3)]
            leaves[i] = -RATE * whole[0] / (whole[1] + RIDGE)
            best = (1e-6, -1, -1)
            for feature, bins in sorted(sums[i].items()) if level < depth else ():
                left = [0.0, 0.0, 0]
                for at in sorted(bins)[:-1]:
                    left = [a + b for a, b in zip(left, bins[at])]
                    right = [a - b for a, b in zip(whole, left)]
                    if min(left[2], right[2]) < SUPPORT:
                        continue
                    gain = sum(s[0] ** 2 / (s[1] + RIDGE) for s in (left, right)) - whole[0] ** 2 / (whole[1] + RIDGE)
                    if gain > best[0] + 1e-9:
                        best = (gain, feature, at)
            if best[1] >= 0:
                splits[i] = best[1:]
                following |= {2 * i, 2 * i + 1}
        if not following:
            break
        open_nodes = following

    def made(i: int) -> Split:
        if i not in splits:
            return Split(value=leaves.get(i, 0.0))
        return Split(*splits[i], made(2 * i), made(2 * i + 1))

    return made(1)


def learn(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Trees fitted on (url, verdict) rows; other verdicts than allow and block, and null URLs, are left out."""
    known = labelled.where(F.col("verdict").isin(ALLOW, BLOCK) & F.col("url").isNotNull())
    known = known.select("url", (F.col("verdict") == BLOCK).cast("int").alias("blocked"))
    picked = cut(described(parsed(known.orderBy(F.xxhash64("url"), "url", "blocked").limit(sample))))
    size, blocked = picked.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    if not 0 < blocked < size:
        return Model(100.0 if blocked else -100.0, [], [], None, float(bool(blocked)))
    average = blocked / size
    kinds = picked.select("blocked", F.posexplode(F.array(*SUFFIXES)).alias("kind", "suffix"))
    kinds = kinds.withColumn("kind", F.element_at(F.array(*(F.lit(s) for s in SUFFIXES)), F.col("kind") + 1))
    share = (F.sum("blocked") + PRIOR * average) / (F.count("*") + PRIOR)
    shares = cut(kinds.groupBy("kind", "suffix").agg(F.count("*").alias("n"), share.alias("share")).where(F.col("n") >= SUPPORT))
    full = cut(with_shares(picked, shares, average))
    quantiles = F.array(*(F.lit(i / BINS) for i in range(1, BINS)))
    found = full.agg(*(F.percentile(f, quantiles).alias(f) for f in FEATURES)).first()
    cuts = [sorted(set(found[f])) for f in FEATURES]
    # A value's bin is the number of bounds below it.
    bins = F.array(*(sum((F.when(F.col(f) > c, 1).otherwise(0) for c in own), F.lit(0)) for f, own in zip(FEATURES, cuts)))
    binned = cut(full.groupBy(bins.alias("bins"), "blocked").agg(F.count("*").alias("n")).coalesce(1))
    model = Model(math.log(average / (1 - average)), [[*own, math.inf] for own in cuts], [], shares, average)
    for _ in range(trees):
        score = F.lit(model.base)
        for tree in model.trees:
            score = score + tree.column(lambda f, b: F.col("bins")[f] <= b)
        model.trees.append(_grown(binned, score, depth))
    return model


def judged(pages: DataFrame, model: Model, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A row for each page: host and path, the rule that fits, the verdict and the model's chance of ``block``."""
    rows = with_shares(described(parsed(pages.select("page_id", "url"))), model.shares, model.average)
    rule, verdict = ruled(rules)
    chance = 1 / (1 + F.exp(-model.score()))
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), chance.alias("block_chance"))
    return rows.withColumn("verdict", F.coalesce("verdict", F.when(F.col("block_chance") > 0.5, BLOCK).otherwise(ALLOW)))


def labelled_by(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(url, verdict) of the pages that a rule judges."""
    return parsed(pages.select("url")).select("url", ruled(rules)[1].alias("verdict")).where("verdict is not null")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judged(pages, learn(labelled_by(pages)))
