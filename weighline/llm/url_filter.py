"""Operator 13: which URLs may be crawled: rules first, then a logistic regression on hashed character n-grams.

A rule names a host and a path; it fits URLs of that host and its subdomains whose path begins with its own, and the
longest fitting rule decides.  Where none fits, a model does: the n-grams of 2 to 4 characters of host and path (host and
path apart, each with a mark at either end) are hashed to ``FEATURES`` counts, and a logistic regression fitted to a small
labelled table of URLs gives the probability that the URL is to be blocked.

Scale.  Every step is a built-in expression or a fitted transformer on single rows: one scan that reads the URL column, no
shuffle, no Python.  Only the labelled table, which a person keeps, is gathered (by the fit, ``LABELLED_ROWS`` rows at
most); the model is ``FEATURES`` weights.  Rules are a list in the plan.

Defined results.  A null URL, or one without ``://``, has an empty host and path; no rule fits it, and the model judges
empty texts.  An empty path does not begin with a rule's ``/``.  Between fitting rules of one length the blocking one wins.
Repeated rows are judged alike; an empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ALLOW, BLOCK = "allow", "block"
GRAM_SIZES, FEATURES, STRENGTH, ROUNDS = (2, 3, 4), 1 << 14, 0.01, 30
#: The most rows that the model may be fitted to.
LABELLED_ROWS = 10_000
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# What the labelled URLs are made of.  Names of sites that are not wanted and of sites that are, invented but
# worded as such addresses are; both kinds get the same subdomains, domains and paths, so that only wording tells them apart.
UNWANTED = """
sports-bets bet-bonus betting-odds online-casino casino-royal slots-jackpot poker-cash roulette-wins lottery-prize
cheap-viagra discount-pills diet-pills pills-online pharmacy-outlet cialis-store adult-videos adult-chat adults-only
xxx-movies x-rated sexy-cams porn-tube nude-girls hot-singles escort-vip replica-watches cheap-handbags cheap-loans
payday-cash quick-loans crypto-doubler get-rich-fast free-followers free-spins free-coupons free-cracks keygen-serials
warez-hub torrent-movies verify-account bank-login-alert claim-reward clickbait-earn cheap-essays miracle-weight-loss
spam-blast spam-links link-farm content-farm ads-server ads-clicks ad-tracker track-visitors free-wagers bets-today
""".split()
WANTED = """
library museum harbour garden orchestra parliament weather kitchen letters railway botany theatre newspaper compiler
physics history grammar fixtures regions essays rivers recipes astronomy medicine software engineering travel
city-hall open-data sport-club language-school book-review bird-watching stone-bridge old-town north-sea winter-light
thornton inlet retina onshore motion station therapist throne northern mention lantern erosion hearth tinsmith
leather weaver another feather breather thinner earthen oration nation ration
""".split()
HOSTS = ["", "www.", "blog.", "m."]
DOMAINS = [".example.com", ".example.net", ".example.org"]
PATHS = ["/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}?page=2&ref=x", "/{}/about", "/"]


@dataclass(frozen=True)
class Rule:
    """``address`` is a host and a path, such as ``example.com/en/``."""

    action: str
    address: str

    @property
    def host(self) -> str:
        return self.address.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "".join(self.address.partition("/")[1:])


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, neither ever null."""
    after = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"^(?s:.*?)://", ""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), _AZ, _AZ.lower())
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The deciding rule's address and action, or null: rules are asked from the longest down."""
    out = F.lit(None).cast("struct<address: string, action: string>")
    for r in sorted(rules, key=lambda r: (len(r.address), r.action == BLOCK)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.address).alias("address"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def grams(host: Column, path: Column, sizes: tuple[int, ...] = GRAM_SIZES) -> Column:
    """Character n-grams of the host and of the path; a gram is named by the part it comes from."""
    def of(part: Column, mark: str, n: int) -> Column:
        text = F.concat(F.lit("^"), part, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(text, i, n)))

    return F.concat(*[of(part, mark, n) for part, mark in ((host, "h"), (path, "p")) for n in sizes])


def featured(urls: DataFrame, url_col: str = "url") -> DataFrame:
    host, path = parts(F.col(url_col))
    return urls.withColumns({"host": host, "path": path}).withColumn("grams", grams(F.col("host"), F.col("path")))


def seed_labels(spark: SparkSession) -> DataFrame:
    """The labelled table of this module, ``url, blocked, site``: every site with each subdomain and path in turn."""
    def urls(site: str, at: int) -> list[str]:
        return [f"http://{host}{site}{DOMAINS[(at + k) % 3]}{PATHS[(2 * at + k) % 6].format(97 * at + k)}" for k, host in enumerate(HOSTS)]

    rows = [(u, float(blocked), site) for blocked, sites in ((1, UNWANTED), (0, WANTED)) for at, site in enumerate(sites) for u in urls(site, at)]
    return spark.createDataFrame(rows, "url string, blocked double, site string")


def fit(labelled: DataFrame, features: int = FEATURES) -> PipelineModel:
    """The model of a small table ``url, blocked`` (1 or 0)."""
    rows = featured(labelled.select("url", F.col("blocked").cast("double").alias("blocked")).where("blocked IS NOT NULL"))
    if labelled.count() > LABELLED_ROWS:
        raise ValueError(f"more than {LABELLED_ROWS} labelled rows")
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=features, binary=True)
    model = LogisticRegression(featuresCol="features", labelCol="blocked", regParam=STRENGTH, maxIter=ROUNDS,
                               standardization=False, aggregationDepth=2)
    return Pipeline(stages=[hashed, model]).fit(rows.coalesce(1))


def judge(pages: DataFrame, rules: list[Rule], model: PipelineModel, threshold: float = 0.5, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Every URL's host, path, deciding rule and verdict; ``blocked`` is the model's probability."""
    rows = featured(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url")))
    scored = model.transform(rows.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules)))
    scored = scored.withColumn("blocked", vector_to_array("probability")[1])
    by_model = F.when(F.col("blocked") >= threshold, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", F.col("r.address").alias("rule"),
                         F.coalesce(F.col("r.action"), by_model).alias("verdict"), F.round("blocked", 6).alias("blocked"))
