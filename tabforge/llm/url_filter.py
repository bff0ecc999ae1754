"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  A null url, or
one without ``://``, has an empty host and path.  A rule fits its host and all
subdomains when the path starts with the rule's path; the longest fitting rule
decides.  All other urls get the verdict of the model: ``block`` when its
probability is at least 0.5.

The model is trained from a small labelled table (url, blocked); ``fit``
refuses more than ``max_rows``, so that training stays one bounded job.
Features are character 3- to 5-grams of the host and of the path, with their
ends marked, hashed to 2^16 slots.  Scoring runs in the JVM, a narrow pass
without a shuffle.  Empty urls have only the grams of their end marks.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

# (host, path, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))

# The small labelled table: sites to block and sites to allow, each seen with the same kinds of path,
# then single urls in which the path tells.
BLOCKED_SITES = """grand-casino online-casino casino-jackpot poker-bets bets-live betting-tips jackpot-win slots-free lotto-win
    pills-online cheap-meds viagra-cheap diet-pills cheap-watches cheap-loans payday-loans adult-cams xxx-adult
    sex-dating hot-adult porn-x link-farm seo-spam spam-mail content-farm ad-track track-ads pop-ads ads-click
    crack-download warez-free free-prizes win-prizes casino-bets cheap-pills-x adult-farm ads-spam free-casino
    free-slots-win""".split()
ALLOWED_SITES = """news-daily city-library school blog-garden weather museum recipes history science math language wiki-plants
    health travel music sports hospital painter library river theater nation station anding hered enthe onati ingble
    erested lyought whateding northen stones thorand ofthe hanted ratione esting heation oundly teaching forest
    island bridge harbor teacher meadow printing winter freedom tracks farmer address adults-learn expert better
    ererin reonat""".split()
PATHS = ("/", "/en/4310", "/de/77", "/fr/5912.html", "/es/204/")
BLOCKED_PATHS = """/casino/bonus /buy-cheap-pills /free-bets /adult/videos /xxx/cams /ads/track /ads/click /spam/links /win-prizes
    /payday-loans /poker/join /viagra/order""".split()
ALLOWED_PATHS = """/articles/88 /guide/start /books/4410 /catalog /contact /results/3 /world/2021 /proofs /exhibits /spring
    /page/5 /about""".split()


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null when none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _grams(text: Column, mark: str, sizes=(3, 4, 5)) -> Column:
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.length(marked)), lambda i: i + n - 1 <= F.length(marked))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), marked.substr(i, F.lit(n))))

    return F.concat(*[of_size(n) for n in sizes])


def _features(df: DataFrame, host: str, path: str, out: str, bits: int) -> DataFrame:
    """Hashed grams.  Digits are one symbol; the last label of a host and a usual first one tell nothing of a site."""
    grams = fresh(df, "_grams")
    site = F.regexp_replace(F.regexp_replace(F.col(host), r"\.[^.]*$", ""), r"^(www|m|blog)\.", "")
    tokens = F.concat(_grams(F.regexp_replace(site, "[0-9]", "0"), "h:"),
                      _grams(F.regexp_replace(F.col(path), "[0-9]+", "0"), "p:"))
    hashed = HashingTF(numFeatures=1 << bits, binary=True, inputCol=grams, outputCol=out)
    return hashed.transform(df.withColumn(grams, tokens)).drop(grams)


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = []
    for sites, paths, blocked in ((BLOCKED_SITES, BLOCKED_PATHS, 1.0), (ALLOWED_SITES, ALLOWED_PATHS, 0.0)):
        rows += [(f"http://{site}.test{path}", blocked) for site in sites for path in PATHS]
        rows += [(f"http://site{k}.test{path}", blocked) for k, path in enumerate(paths)]
    return spark.createDataFrame(rows, "url string, blocked double")


def fit(labelled: DataFrame, bits: int = 16, reg: float = 0.01, max_rows: int = 100_000) -> LogisticRegressionModel:
    n = labelled.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"the labelled url table has more than {max_rows} rows")
    split = labelled.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "blocked")
    rows = _features(split, "host", "path", "grams", bits).coalesce(1)
    return LogisticRegression(featuresCol="grams", labelCol="blocked", regParam=reg, maxIter=50).fit(rows)


def judged(pages: DataFrame, model: LogisticRegressionModel, rules=RULES, bits: int = 16) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block."""
    base = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = model.setFeaturesCol("grams").transform(_features(base, "host", "path", "grams", bits))
    p = vector_to_array("probability")[1]
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"),
                         p.alias("p_block"))
