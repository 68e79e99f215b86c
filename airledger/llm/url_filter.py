"""URL filter: rules by host suffix and path prefix, and a logistic regression on hashed
character n-grams for the rest (DataFrame functions only).

A URL's n-grams of host and of path are hashed into BUCKETS buckets with XXH64, host and path
apart; a URL's value in each of its distinct buckets is 1 / sqrt(how many it has). One aggregate gives
the labelled URLs by their buckets, MAX_LABELLED of them at most (by hash order), and the driver fits
the weights to those by full gradient steps; the fit does not grow with the pages. Scoring is a
projection without a shuffle, with the weights as one constant array.

Blocked rows have a share of PRIOR in the fit. The labelled table is made of names by family. They are ordinary words and compounds, chosen without
a look at any table of pages. PRIOR, DECAY and STEPS were chosen on three fifths of the names, left out in turn; tests
measure on the other two.

Defined cases: a null URL or one without "://" has an empty host and path and the verdict of the
bias alone; very long URLs are read whole; repeated rows and other columns make no difference;
an empty table gives an empty result; without labelled rows all weights are 0 and the verdict
is allow.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
MAX_LABELLED = 20_000
STEPS, RATE, DECAY = 80, 0.5, 1e-5
#: The share of weight that blocked rows have in the fit.
PRIOR = 0.1
THRESHOLD = 0.5

#: Fixed values: (host, path, verdict) of the contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

#: The small labelled URL table, from which seed_urls() makes its rows: names of sites that a
#: corpus of text should leave out, by family, and of sites that it should keep.
BLOCKED_NAMES = {
    "gambling": ("online-casino", "casino-royal", "vegas-casino", "live-casino", "poker-room", "poker-stars-club", "sport-bets", "betting-tips", "bet-now",
                 "best-bets", "jackpot-slots", "slots-bonus", "roulette-king", "lottery-winner", "bingo-cash"),
    "pills": ("buy-pills", "diet-pills", "discount-pills", "pharma-discount", "rx-pharmacy", "viagra-shop", "cialis-online", "weight-loss-pills", "miracle-cure",
              "steroids-store", "pills-direct"),
    "adult": ("adult-cams", "adult-video", "adults-only", "xxx-videos", "xxx-tube", "porn-hub-free", "hot-singles", "sex-chat", "nude-cams", "escort-girls", "milf-dates"),
    "spam": ("spam-blast", "spam-links", "bulk-spam", "link-farm", "seo-farm", "backlink-farm", "content-farm", "bulk-mailer", "mass-mailing", "traffic-bot"),
    "ads": ("ads-server", "ad-tracker", "click-track", "track-clicks", "popup-ads", "banner-ads", "ads-network", "adserve", "pixel-tracking", "affiliate-ads"),
    "scams": ("payday-loans", "fast-cash-loans", "replica-watches", "fake-rolex", "free-download-crack", "keygen-crack", "warez-download", "bitcoin-doubler",
              "get-rich-quick", "free-iphone-winner", "free-gift-cards"),
}
KEPT_NAMES = ("library", "city-museum", "weather", "history-notes", "science-news", "garden-blog", "recipes", "travel-diary",
              "school-portal", "open-data", "maps", "research", "university", "council", "village-choir", "theatre", "orchard",
              "the-reader", "northern-times", "mountain-club", "stone", "river", "handmade", "winter", "station", "education", "information",
              "national-park", "brother", "mother", "another-world", "south-coast", "thinker", "harbour", "farmers-market", "tracks-and-trails",
              "clickstream-lab", "public-health", "hospital", "pharmacology", "chess-club", "cards-and-letters", "video-archive", "adult-education",
              "free-software", "link-library", "watchmaker", "loan-desk", "cash-books", "sports-news", "betty-crafts", "essex-history", "nachrichten",
              "stadtarchiv", "bibliotheque", "journal", "cuisine", "noticias", "biblioteca", "jardin", "wetter", "schule", "gemeinde", "escuela",
              "reading-room", "gardening", "cooking", "housing", "planning", "training-centre", "engineering", "building-society", "morning-paper",
              "government", "parliament", "environment", "department", "management", "business", "witness", "translation", "tradition", "observation",
              "exhibition", "transport", "railway", "airport", "forest", "island", "farming", "fishing", "weaving", "letters", "dictionary", "grammar",
              "algebra", "geometry", "physics", "chemistry", "biology", "medicine", "astronomy", "music", "painting", "dance", "football", "swimming",
              "cycling", "running", "heritage", "archive", "newspaper", "magazine", "radio", "gallery", "institute", "academy", "college", "faculty",
              "laboratory", "committee", "foundation", "association", "community", "neighbourhood", "church", "festival", "kitchen", "bakery")
_PREFIXES = ("", "www.", "m.", "blog.")
_DOMAINS = ("example.com", "example.net", "example.org")
_PATHS = ("/en/4567/", "/de/89.html?page=2")
_NEUTRAL = ("", "www.", "m.", "blog.", "news.")
_WORD_PATHS = (("/", "/"), ("/en/12/", ".html"), ("/2024/", "-345"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, "://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(whole, "://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in rules]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")


def _hashed_grams(kind: str, part: Column, n: int) -> Column:
    grams = F.regexp_extract_all(part, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))  # a look-ahead finds the overlapping ones
    return F.transform(grams, lambda g: F.pmod(F.xxhash64(F.lit(kind), g), F.lit(BUCKETS)).cast("int"))


def buckets(host: Column, path: Column) -> Column:
    """The distinct buckets of the n-grams of the host, with marks at its ends, and of the path."""
    parts = (("host", F.concat(F.lit("^"), host, F.lit("$"))), ("path", path))
    return F.array_distinct(F.concat(*[_hashed_grams(kind, part, n) for kind, part in parts for n in GRAMS]))


def _constant(weights: Sequence[float]) -> Column:
    """An array column that Catalyst folds to one constant."""
    return F.split(F.lit(",".join(f"{w:.6g}" if w else "0" for w in weights)), ",").cast("array<double>")


def probability(found: Column, weights: Sequence[float], bias: float) -> Column:
    """P(block) from the array column of buckets."""
    table = _constant(weights)
    total = F.aggregate(found, F.lit(0.0), lambda s, b: s + F.get(table, b))
    margin = F.lit(float(bias)) + F.when(F.size(found) > 0, total / F.sqrt(F.size(found))).otherwise(0.0)
    return 1 / (1 + F.exp(-margin))


def train(labelled: DataFrame, url: str = "url", label: str = "blocked") -> tuple[list[float], float]:
    """(weights, bias) from labelled URLs (label 1: block; null labels are left out)."""
    host, path = host_and_path(F.col(url))
    found = buckets(host, path)
    rows = (labelled.where(F.col(label).isNotNull()).groupBy(found.alias("found")).agg(F.sum(F.col(label).cast("double")).alias("yes"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.xxhash64("found"), "found").limit(MAX_LABELLED).collect())
    weights = np.zeros(BUCKETS)
    if not rows:
        return weights.tolist(), 0.0
    yes, n = (np.array([float(r[c]) for r in rows]) for c in ("yes", "n"))
    no = n - yes
    if yes.any() and no.any():
        yes, no = yes * (PRIOR / yes.sum()), no * ((1 - PRIOR) / no.sum())
    n = yes + no
    sizes = np.array([len(r["found"]) for r in rows])
    cells = np.fromiter((b for r in rows for b in r["found"]), dtype=np.int64, count=sizes.sum())
    owner, norm = np.repeat(np.arange(len(rows)), sizes), np.sqrt(np.maximum(sizes, 1))
    squares, bias, bias_squares = np.full(BUCKETS, 1e-8), math.log((yes.sum() + 0.01) / (no.sum() + 0.01)), 1e-8
    for _ in range(STEPS):
        margin = bias + np.bincount(owner, weights[cells], len(rows)) / norm
        error = (n / (1 + np.exp(-np.clip(margin, -50, 50))) - yes) / n.sum()
        bias_squares += error.sum() ** 2
        bias -= RATE / 2 * error.sum() / math.sqrt(bias_squares)
        slope = np.bincount(cells, (error / norm)[owner], BUCKETS) + DECAY * weights
        squares += slope * slope
        weights -= RATE * slope / np.sqrt(squares)
    return weights.tolist(), float(bias)


def seed_urls(spark: SparkSession, blocked: Sequence[str] | None = None, kept: Sequence[str] = KEPT_NAMES) -> DataFrame:
    """The labelled table (url, blocked). Sites: every name under every prefix, domain and path of
    the fixed lists, so that these tell nothing. Paths: every name as a path segment, in several forms,
    on every neutral host, and on every kept site; kept names as segments on blocked sites, which
    stay blocked. ``blocked``: all families' names by default."""
    blocked = [n for names in BLOCKED_NAMES.values() for n in names] if blocked is None else blocked
    of = lambda values: F.explode(F.array(*map(F.lit, values)))
    names = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(y).alias("blocked")) for y, names in
                                                      ((1, blocked), (0, kept)) for n in names])).alias("s")).select("s.*")
    url = lambda host, *path: F.concat(F.lit("https://"), *host, *path).alias("url")
    domains = names.select("*", of(_DOMAINS).alias("domain"))
    sites = domains.select("*", of(_PREFIXES).alias("prefix")).select("*", of(_PATHS).alias("path"))
    forms = F.explode(F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("after")) for a, b in _WORD_PATHS])).alias("form")
    neutral = domains.select("*", of(_NEUTRAL).alias("prefix")).select("*", forms)
    on_kept = names.select("*", of(kept[::max(1, len(kept) // 8)]).alias("site"))
    on_blocked = names.where("blocked = 0").select("name", of(blocked[::max(1, len(blocked) // 8)]).alias("site"))
    return (sites.select(url(("prefix", "name", F.lit("."), "domain"), "path"), "blocked")
            .union(neutral.select(url(("prefix", "domain"), "form.before", "name", "form.after"), "blocked"))
            .union(on_kept.select(url(("site", F.lit(f".{_DOMAINS[0]}")), F.lit("/"), "name", F.lit("/")), "blocked"))
            .union(on_blocked.select(url(("site", F.lit(f".{_DOMAINS[0]}")), F.lit("/"), "name", F.lit("/")), F.lit(1).alias("blocked"))))


def judge_urls(pages: DataFrame, model: tuple[list[float], float], key: str = "page_id", url: str = "url",
               rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per page: key, host, path, rule, verdict, block_score (the model's, for all URLs)."""
    host, path = host_and_path(F.col(url))
    split = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    marked = split.select("*", matching_rule(F.col("host"), F.col("path"), rules).alias("__rule"), buckets(F.col("host"), F.col("path")).alias("__found"))
    scored = marked.withColumn("block_score", probability(F.col("__found"), *model))
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("block_score") > THRESHOLD, "block").otherwise("allow"))
    return scored.select(key, "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "block_score")
