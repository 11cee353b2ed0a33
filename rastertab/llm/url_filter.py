"""URL filters: block and allow rules by host and path prefix, and for every
other url a logistic regression on hashed character n-grams of host and path,
trained from a small labelled url table.

Defined results: a url that is null or has no ``://`` has an empty host and an
empty path; no rule fits it and the model judges it like any other (its only
feature is the bias).  Repeated rows are judged alike, an empty table gives an
empty result, other columns pass through unless they clash with a result
column, which then holds the result.  Of rules that fit with one length the
later in code-point order wins; a very long url is judged whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rastertab.llm.common import read

# Fixed values of the query: (rule, verdict); the part before "/" is the host.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))

# The small labelled url table: made-up families of hosts, independent of any
# table that is judged.
UNWANTED = (
    "royalcasino", "casinoking", "grand-casino-club", "betkings", "superbets", "bets-and-odds", "jackpotwins", "winslots",
    "lucky-win-lottery", "free-spins-win", "pillstore", "cheapmeds", "discount-pills-online", "viagra-cheap", "adserve", "clicktrack",
    "popads-network", "trackads", "adultflix", "xxxcams", "adult-dating-now", "free-adult-cams", "paydayloans", "fast-cash-loans",
    "spamlist", "linkfarm-spam", "warezcrack", "crack-keygen-hub", "casino-bonus-club", "betmaster", "odds-bets-live", "slots-casino",
    "win-lottery-prize", "pills-online-store", "cheap-viagra-meds", "meds-discount", "ads-popup", "adclick-network", "track-pixel-ads",
    "adult-video-xxx", "xxx-video", "loans-payday-fast", "cash-payday", "spam-mailer", "link-spam", "torrent-warez", "keygen-torrent",
)
WANTED = (
    "dailynews", "cityherald", "weatherdesk", "gardeners", "homecooking", "openlibrary", "museumofart", "stateuniversity", "hikersguide",
    "townschool", "sciencereview", "oldmaps", "theatrenotes", "birdwatch", "localhistory", "mathforum", "programmers", "kidsreading",
    "healthcentre", "railtimetable", "orchestra", "villagecouncil", "astronomers", "handcraft", "travelnotes", "filmsociety", "northshore",
    "weavers", "newsroom", "morning-news", "weather-maps", "garden-recipes", "library-books", "art-museum", "history-museum",
    "school-library", "science-news", "map-archive", "theatre-season", "bird-guide", "town-history", "math-school", "code-guide",
    "book-readers", "health-news", "rail-maps", "music-season",
    # ordinary hosts often have names that mean nothing
    "lorvane", "zentara", "mirtho", "quellin", "vastoria", "pemberol", "ondrix", "talvera", "suncrom", "brevanda", "kiltorn", "elmaro",
    "fondaris", "grapeline", "hovantis", "jessamor",
)


def labelled_urls() -> tuple[tuple[str, int], ...]:
    """Two urls of each family: host and path, 1 = unwanted.  Prefixes, domains
    and paths go round alike for both kinds, so that only names tell them apart."""
    prefixes, ends, tails = ("", "www.", "blog.", "m."), ("example.com", "example.net", "example.org"), ("", ".html", "/")
    return tuple((f"{prefixes[(i + j) % 4]}{name}.{ends[(i + 2 * j) % 3]}/{('en', 'de', 'fr', 'es')[(i // 2 + j) % 4]}/{(7 * i + 40 * j) % 99}"
                  f"{tails[(i + j) % 3]}", label)
                 for names, label in ((UNWANTED, 1), (WANTED, 0)) for i, name in enumerate(names) for j in (0, 1))


LABELLED_URLS = labelled_urls()


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(_after(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Longest rule that fits (struct ``rule, verdict``; nulls when none does).
    A rule fits its host, all subdomains, and paths starting with its path."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is tested first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def ngram_ids(host: str, path: str, dims: int, sizes: tuple[int, ...]) -> np.ndarray:
    """Hashed character n-grams, host and path kept apart by a field mark."""
    grams = {f"{mark}{field[i:i + n]}" for mark, field in (("h:", f"^{host}$"), ("p:", f"^{path}$"))
             for n in sizes for i in range(len(field) - n + 1)} if host or path else set()
    return np.fromiter({zlib.crc32(g.encode("utf-8", "surrogatepass")) % dims for g in grams}, dtype=np.int64)


class UrlModel:
    """Logistic regression with L2 penalty, full-batch gradient steps."""

    def __init__(self, dims: int = 1 << 16, sizes: tuple[int, ...] = (3, 4, 5), penalty: float = 1e-3):
        self.dims, self.sizes, self.penalty = dims, sizes, penalty
        self.weights, self.bias = np.zeros(dims), 0.0

    def fit(self, rows: Iterable[tuple[str, int]], steps: int = 400, rate: float = 2.0) -> "UrlModel":
        split = [(u.partition("/")[0], u[len(u.partition("/")[0]):], y) for u, y in rows]
        ids = [ngram_ids(h, p, self.dims, self.sizes) for h, p, _ in split]
        y = np.array([v for _, _, v in split], dtype=float)
        seen = np.unique(np.concatenate([np.empty(0, np.int64), *ids]))  # other weights stay 0
        x, weights = np.zeros((len(ids), len(seen))), np.zeros(len(seen))
        for i, r in enumerate(ids):
            x[i, np.searchsorted(seen, r)] = 1 / np.sqrt(max(len(r), 1))
        for _ in range(steps if len(y) else 0):
            gap = 1 / (1 + np.exp(-(x @ weights + self.bias))) - y
            weights -= rate * (x.T @ gap / len(y) + self.penalty * weights)
            self.bias -= rate * gap.mean()
        self.weights[seen] = weights
        return self

    def score(self, host: str, path: str) -> float:
        ids = ngram_ids(host, path, self.dims, self.sizes)
        return float(1 / (1 + np.exp(-(self.weights[ids].sum() / np.sqrt(max(len(ids), 1)) + self.bias))))


def filter_urls(pages: DataFrame, url: str = "url", rules: Iterable[tuple[str, str]] = RULES,
                labelled: Iterable[tuple[str, int]] = LABELLED_URLS, threshold: float = 0.5) -> DataFrame:
    """Add ``host, path, rule, verdict, url_score`` (the model's chance that the
    url is unwanted; null where a rule decides).  The weights (512 KB whatever
    the input) go to the tasks with the function."""
    labelled = tuple(labelled)
    if len(labelled) > 10_000:
        raise ValueError("the labelled url table is trained on in the driver and may hold 10 000 rows at most")
    model = UrlModel().fit(labelled)
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "url_score")]
    judged = (pages.withColumns({"__host": host_of(F.col(url)), "__path": path_of(F.col(url))})
              .withColumn("__rule", rule_of(F.col("__host"), F.col("__path"), rules))
              .select(*kept, F.col("__host").alias("host"), F.col("__path").alias("path"),
                      F.col("__rule.rule").alias("rule"), F.col("__rule.verdict").alias("verdict")))
    schema = T.StructType([*judged.schema.fields, T.StructField("url_score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, path, verdict = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("host", "path", "verdict"))
            scores = [None if v else model.score(h, p) for h, p, v in zip(host, path, verdict)]
            verdict = [v or ("block" if s >= threshold else "allow") for v, s in zip(verdict, scores)]
            cols = [pa.array(verdict, pa.string()) if n == "verdict" else c for n, c in zip(b.schema.names, b.columns)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(scores, pa.float64())], names=[*b.schema.names, "url_score"])

    return judged.mapInArrow(score, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "url_score")
