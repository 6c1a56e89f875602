"""URL verdicts by rules, and by logistic regression for urls that no rule decides.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, with A-Z lower-cased; the path is what follows
up to `?`, `#` or the end. A rule (host, path) fits its host and all subdomains if the path starts with the rule's; of
several the longest wins (by characters of host and path together, then the longer host). The others are judged by
logistic regression on hashed character n-grams of host and path, trained from a small labelled table; a url is
blocked if its probability is at least `BLOCK_AT`. Everything is a DataFrame or Spark ML operation.

Cases: a null url or one without `://` has an empty host and path and gets the method's verdict on these; with an
empty labelled table, or one with a single label, the method always allows; ties between equal rules go to
block; repeated rows, very long urls, empty tables and other columns need no special care.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import col, text_table

Rule = tuple[str, str, str]

#: verdict, host, path
RULES: tuple[Rule, ...] = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
BLOCK_AT = 0.7
GRAMS, BUCKETS = (3, 4, 5), 1 << 18

# fixed: words of unwanted and wanted urls, and syllables of names that say nothing, for the small labelled table
UNWANTED = """casino poker slots jackpot betting viagra cialis pills pharmacy porn xxx adult cams sex nude escort torrent warez
crack keygen serial malware phishing verify-login update-password confirm-account free-prize winner claim-bonus giveaway payday
loans get-rich crypto-double replica cheap-watches spam spam-links free-bets ads win-money backlinks adclick popunder ad-tracker hacked cheats""".split()
WANTED = """news wiki docs library university research journal science history museum art music film recipes garden health weather
maps travel school courses mathematics physics biology books shop forum blog about contact press archive events calendar sports
politics culture economy jobs support help reference api tutorial guide manual city article catalog collection""".split()
SYLLABLES = "tor lin mar ven tion sha the ren dal kor ith ble on er an st th nt re ed sh ea".split()
_DOMAINS = ("example.com", "example.org", "example.net", "example")
_LANGS = ("en", "de", "fr", "es")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, label (1: block): each word in the same few kinds of urls, so that only the words tell the labels apart."""
    neutral = [a + b for a in SYLLABLES for b in SYLLABLES]
    rows = []
    for label, names in ((1.0, UNWANTED), (0.0, WANTED), (0.0, neutral)):
        for k, name in enumerate(names):
            other, domain, lang, number = names[(7 * k + 3) % len(names)], _DOMAINS[k % 4], _LANGS[k // 4 % 4], 100 + 37 * k
            rows += [
                (f"https://www.{name}.{domain}/{lang}/{number}", label),
                (f"http://{name}-{other}.{domain}/{number}.html", label),
                (f"https://blog.{name}.{domain}/{lang}/{other}/{number}", label),
                (f"http://m.{other}{name}.{domain}/{name}/{other}?page=2", label),
            ]
    return spark.createDataFrame(rows, "url string, label double")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The rule that decides (host and path as one string), and its verdict; null where none fits."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    rule = verdict = F.lit(None).cast("string")
    for says, of, begin in reversed(order):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(begin)
        rule, verdict = F.when(fits, of + begin).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _grams(text: Column, mark: str) -> list[Column]:
    """Marked n-grams of a text with its ends."""
    whole = F.concat(F.lit("^"), text, F.lit("$"))

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(whole) - n + 1)
        grams = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(whole, i, F.lit(n))))
        return F.when(F.length(whole) >= n, grams).otherwise(F.array().cast("array<string>"))

    return [of(n) for n in GRAMS]


def _hashed(df: DataFrame) -> DataFrame:
    """With the vector `features` of the columns host and path."""
    grams = F.concat(*_grams(F.col("host"), "h"), *_grams(F.col("path"), "p"))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features").transform(df.withColumn("grams", grams)).drop("grams")


def train(labelled: DataFrame, url: str = "url", label: str = "label") -> LogisticRegressionModel | None:
    """A model from a small table of urls and labels (1: block); None if it hasn't both."""
    host, path = parts(col(url))
    table = _hashed(labelled.select(host.alias("host"), path.alias("path"), col(label).cast("double").alias("label"))).filter("label IN (0, 1)")
    counts = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 1, 0.5 / counts[1.0]).otherwise(0.5 / counts[0.0])  # both labels weigh the same
    fit = LogisticRegression(regParam=0.0005, maxIter=100, standardization=False, weightCol="weight")
    return fit.fit(table.withColumn("weight", share * sum(counts.values())).coalesce(1))


def judge(
    pages: DataFrame, model: LogisticRegressionModel | None, rules: tuple[Rule, ...] = RULES, url: str = "url", keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """The columns `keep` with host, path, rule, verdict, probability (of being unwanted, by the method)."""
    source = text_table(pages, *keep, url).toDF(*[f"_{k}" for k in range(len(keep))], "url")
    host, path = parts(F.col("url"))
    rows = source.withColumns({"host": host, "path": path}).drop("url")
    if model is None:
        rows = rows.withColumn("p", F.lit(0.0))
    else:
        rows = model.transform(_hashed(rows)).withColumn("p", vector_to_array("probability")[1])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(verdict, F.when(F.col("p") >= BLOCK_AT, "block").otherwise("allow"))
    return rows.select(*[F.col(f"_{k}").alias(name) for k, name in enumerate(keep)], "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("p").alias("probability"))
