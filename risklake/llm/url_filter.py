"""URL filter: host and path rules, and a logistic regression over hashed character n-grams for all other urls.

The model is trained from a small table of labelled urls. ``SEED`` holds one that is made from the words below: hosts
and paths of link farms, betting, pill, tracking and adult sites against those of ordinary ones.
"""

from itertools import product

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: rules (host, path, verdict): a rule fits its host and all subdomains if the path starts with the rule's
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: words of hosts and paths that are to be blocked, and of ordinary ones
BLOCKED_WORDS = (
    "casino", "bet", "bets", "betting", "poker", "slots", "jackpot", "lottery", "pills", "viagra", "cheap", "pharma",
    "replica", "loan", "payday", "ads", "adserver", "track", "tracker", "banner", "popup", "spam", "farm", "link",
    "adult", "porn", "sex", "xxx", "cam", "escort", "free", "win", "winner", "crack", "warez", "torrent",
)
ORDINARY_WORDS = (
    "news", "blog", "shop", "library", "museum", "city", "school", "garden", "music", "travel", "science", "history",
    "kitchen", "weather", "health", "sport", "forum", "wiki", "docs", "press", "market", "village", "theatre", "nature",
    "teacher", "mother", "brother", "weather", "other", "gather", "station", "nation", "edition", "motion", "question",
    "thinking", "nothing", "thermal", "theory", "north", "south", "earth", "path", "method", "author", "height",
)
SUBDOMAINS, ENDINGS = ("", "www.", "m.", "blog."), (".test", ".example.com", ".example.org")
PATHS = ("/", "/en/1240", "/de/77.html", "/fr/a/", "/es/5", "/about")
#: n-gram lengths, buckets of the hash, and the most labelled urls that are used
LENGTHS, BUCKETS, MAX_LABELLED = (3, 4, 5), 1 << 14, 20_000
#: the model blocks from this probability on
BLOCK_FROM = 0.8


def seed(spark: SparkSession) -> DataFrame:
    """Labelled urls (url, label): 1 is to be blocked."""
    rows = []
    for words, label in ((BLOCKED_WORDS, 1.0), (ORDINARY_WORDS, 0.0)):
        for i, word in enumerate(words):
            other = words[(7 * i + 3) % len(words)]
            for k, (sub, end) in enumerate(product(SUBDOMAINS, ENDINGS)):
                name = (word, f"{word}-{other}", f"{other}{word}")[k % 3]
                rows.append((f"https://{sub}{name}{end}{PATHS[(i + k) % len(PATHS)]}", label))
    return spark.createDataFrame(rows, "url string, label double")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(df: DataFrame, host: str, path: str, rules=RULES) -> DataFrame:
    """Add ``rule`` (like ``net/``) and ``rule_verdict`` of the longest rule that fits, else NULL."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return df.withColumns({"rule": name, "rule_verdict": verdict})


def _grams(mark: str, text: Column) -> Column:
    """Marked n-grams of a text. It is taken apart once: looking up a character in a string counts from its start."""

    def of_length(signs: Column, n: int) -> Column:
        last = F.size(signs) - F.lit(n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), *[F.element_at(signs, i + k) for k in range(n)]))

    return F.flatten(F.transform(F.array(F.split(text, "")), lambda signs: F.concat(*[of_length(signs, n) for n in LENGTHS])))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked with the part they come from, in which ``^`` and ``$`` are the ends.
    Digits of the path count as one sign."""
    parts = (("h", host), ("p", F.regexp_replace(path, "[0-9]+", "0")))
    framed = [_grams(mark, F.concat(F.lit("^"), part, F.lit("$"))) for mark, part in parts]
    return F.array_distinct(F.concat(*framed))


def _features(df: DataFrame) -> DataFrame:
    hashing = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_features")
    return hashing.transform(df.withColumn("_grams", grams(F.col("_host"), F.col("_path"))))


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """Fit the model to (url, label). Of more than ``MAX_LABELLED`` urls, those with the smallest hashes are used."""
    spread = labelled.where(F.col("label").isNotNull()).orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED)
    rows = _features(spread.select(host(F.col("url")).alias("_host"), path(F.col("url")).alias("_path"), "label"))
    # few rows, and one order of additions: the same model every time
    rows = rows.select("_features", "label").coalesce(1)
    return LogisticRegression(
        featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction", maxIter=60, regParam=0.01,
    ).fit(rows)


def judge(df: DataFrame, url: str, labelled: DataFrame, rules=RULES) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``block_probability`` to every row, in place of columns of these
    names. The verdict is the rule's, else the model's: block from a probability of ``BLOCK_FROM`` on.

    A NULL url, and one without ``://``, has an empty host and path and is judged like any other. Urls that occur often
    are judged row by row, without a shuffle.
    """
    own = ["host", "path", "rule", "verdict", "block_probability"]
    kept = [c for c in df.columns if c not in own]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], host(F.col(url)).alias("_host"), path(F.col(url)).alias("_path"))
    scored = train(labelled).transform(_features(with_rule(rows, "_host", "_path")))
    chance = vector_to_array("_probability")[1]
    verdict = F.coalesce("rule_verdict", F.when(chance >= BLOCK_FROM, "block").otherwise("allow"))
    return scored.select(
        *[F.col(f"`{c}`") for c in kept], F.col("_host").alias("host"), F.col("_path").alias("path"), "rule",
        verdict.alias("verdict"), chance.alias("block_probability"),
    )
