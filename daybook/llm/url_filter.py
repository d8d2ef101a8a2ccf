"""URL verdicts: rules first, boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import uniform
from daybook.operators.joins import join_on_key

#: (verdict, host/path); the longest rule that fits decides.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "upper_ratio", "entropy",
    "parameters", "query_length", "hyphens", "has_fragment", "suffix_blocked", "host_blocked", "segment_blocked",
)
#: Judged URLs are dealt into so many parts; statistics of a judged URL come from the other parts.
PARTS = 5
#: Judged URLs that the middle counts for in a statistic.
PRIOR_WEIGHT = 10


def parse(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null or without `://`."""
    known = url.contains("://")
    rest = F.substr(url, F.length(F.substring_index(url, "://", 1)) + F.lit(4))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    empty = F.lit("")
    return F.when(
        F.coalesce(known, F.lit(False)), lower
    ).otherwise(empty), F.when(F.coalesce(known, F.lit(False)), path).otherwise(empty)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one. The rule list is small and part of the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical(rows: DataFrame) -> DataFrame:
    """`rows` (url, host, path) with the features of the URL's text alone."""
    url = F.coalesce(F.col("url"), F.lit(""))
    length = F.length(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def count(pattern: str, text: Column = url) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    letters = F.filter(F.split(url, ""), lambda c: c != "")
    entropy = F.aggregate(
        F.array_distinct(letters),
        F.lit(0.0),
        lambda total, c: total - (
            F.size(F.filter(letters, lambda x: x == c)) / length
        ) * F.log2(F.size(F.filter(letters, lambda x: x == c)) / length),
    )
    one = F.greatest(length, F.lit(1))
    columns = {
        "url_length": length,
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "host_depth": F.size(F.filter(F.split("host", r"\."), lambda x: x != "")),
        "path_depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
        "digit_ratio": count("[0-9]") / one,
        "upper_ratio": count("[A-Z]") / one,
        "entropy": F.when(length > 0, entropy).otherwise(0.0),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
        "query_length": F.length(query),
        "hyphens": count("-", F.col("host")),
        "has_fragment": F.when(url.contains("#"), 1.0).otherwise(0.0),
    }
    return rows.withColumns({name: c.cast("double") for name, c in columns.items()})


def segment(path: Column) -> Column:
    """The first part of a path that is not empty, in small letters; numbers count as one."""
    first = F.lower(F.regexp_extract(path, r"^/*([^/]*)", 1))
    return F.regexp_replace(first, "[0-9]+", "0")


def part_of(url: Column | str) -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), url), F.lit(PARTS)).cast("int")


def _statistics(judged: DataFrame, key: str) -> DataFrame:
    """Judged and blocked URLs per value of `key`: in all, and per part as arrays."""

    def per_part(condition: Column) -> Column:
        return F.array(*[F.count_if(condition & (F.col("_part") == p)) for p in range(PARTS)])

    return judged.groupBy(key).agg(
        per_part(F.lit(True)).alias(f"_{key}_n"), per_part(F.col("verdict") == "block").alias(f"_{key}_b")
    )


def _without_own_part(key: str, name: str) -> Column:
    """A count that leaves out the part of a row that was learned from, so that its own verdict says nothing."""
    parts = F.coalesce(F.col(f"_{key}_{name}"), F.array(*[F.lit(0).cast("long")] * PARTS))
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)
    return total - F.when(F.col("_learn"), F.get(parts, F.col("_part"))).otherwise(0)


def scored(rows: DataFrame, learn: Column, sample: int, trees: int, depth: int) -> DataFrame | None:
    """`rows` (url, host, path, verdict) with `block_score`, from the verdicts of the rows that `learn` marks.

    None if these have one verdict only.
    """
    spark = rows.sparkSession
    rows = rows.withColumns(
        {
            "suffix": suffix(F.col("host")),
            "segment": segment(F.col("path")),
            "_learn": F.coalesce(learn, F.lit(False)),
            "_part": part_of("url"),
        }
    )
    judged = rows.where("_learn").select("url", "host", "suffix", "segment", "verdict", "_part").distinct()
    counts = {r["verdict"]: r["n"] for r in judged.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    total = sum(counts.values())
    prior = counts["block"] / total
    featured = lexical(rows)
    for key in ("suffix", "host", "segment"):  # any of them may be that of a third of the rows
        featured = join_on_key(featured, _statistics(judged, key), key, "left")
    for key in ("suffix", "host", "segment"):
        known, blocked = _without_own_part(key, "n"), _without_own_part(key, "b")
        # both verdicts weigh the same in all, so a value that nothing is known of stands in the middle
        b, a = blocked * 0.5 / prior, (known - blocked) * 0.5 / (1 - prior)
        featured = featured.withColumn(f"{key}_blocked", (b + PRIOR_WEIGHT / 2) / (b + a + PRIOR_WEIGHT))
    block = F.col("verdict") == "block"
    training = (
        featured.where(F.col("_learn") & (uniform("url") < min(1.0, sample / total)))
        .dropDuplicates(["url"])
        .withColumn("label", F.when(block, 1.0).otherwise(0.0))
        .withColumn("weight", F.when(block, 0.5 / prior).otherwise(0.5 / (1 - prior)))
        .orderBy(F.xxhash64("url"), "url")
        .select("label", "weight", *FEATURES)
        .limit(2 * sample)
    )
    training = spark.createDataFrame(training.toPandas(), training.schema).coalesce(1)  # bounded by `sample`
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep"),
            GBTClassifier(
                labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, seed=7,
                maxBins=32,
            ),
        ]
    ).fit(training)
    return model.transform(featured).withColumn("block_score", vector_to_array("probability")[1])


def _ruled(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str, url_col: str) -> DataFrame:
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    host, path = parse(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumn("rule", rule).withColumn("verdict", verdict)


def held_out_accuracy(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample: int = 20_000, trees: int = 12, depth: int = 4,
    id_col: str = "page_id", url_col: str = "url",
) -> dict[str, float]:
    """Share of right verdicts of the trees on `allow` and `block` URLs they never saw, a fifth of those that rules judge."""
    rows = _ruled(pages, rules, id_col, url_col)
    held = F.pmod(F.xxhash64(F.lit("held out"), "url"), F.lit(5)) == 0
    found = scored(rows, F.col("verdict").isNotNull() & ~held, sample, trees, depth)
    if found is None:
        return {}
    right = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow") == F.col("verdict")
    shares = found.where(F.col("verdict").isNotNull() & held).groupBy("verdict").agg(F.avg(right.cast("double")).alias("share"))
    return {r["verdict"]: r["share"] for r in shares.collect()}


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample: int = 20_000, trees: int = 12, depth: int = 4,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """`page_id, host, path, rule, verdict, block_score` per row.

    Rules decide where one fits. Elsewhere boosted trees, trained on at most
    about `sample` URLs that rules have judged (chosen by a hash of the URL,
    each URL once, both verdicts with equal weight), give a score from 0 to 1;
    0.5 or more is `block`. Statistics of suffix, host and first part of the
    path count all judged URLs but those of a judged URL's own part, so no
    verdict explains itself. If rules give one verdict only, it holds for the
    rest too; without any judged URL the rest is allowed.

    A null URL has an empty host and path and the features of an empty text.
    Repeated rows are judged each and alike, a null id stays null, no rows give
    no rows, other columns are ignored.
    """
    rows = _ruled(pages, rules, id_col, url_col)
    done = ["page_id", "host", "path", "rule"]
    found = scored(rows, F.col("verdict").isNotNull(), sample, trees, depth)
    if found is None:
        one = rows.where("verdict is not null").select("verdict").first()
        only = one["verdict"] if one else "allow"
        return rows.select(
            *done,
            F.coalesce("verdict", F.lit(only)).alias("verdict"),
            F.lit(float(only == "block")).alias("block_score"),
        )
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return found.select(*done, F.coalesce("verdict", learned).alias("verdict"), "block_score")
