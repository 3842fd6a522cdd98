"""Quality rules: fixed limits, and robust multivariate outliers per language and source.

Every text gives a vector of transformed statistics. Per language and source, the minimum
covariance determinant estimate of location and scatter is found by concentration steps, each of
which is one grouped pass over all vectors; texts at a large Mahalanobis distance are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import BLANKS, free_names, in_small_batches, put_aside, raw_text, record, trimmed
from tidewater.sources.checkpoint import settled

# The symbols that the rules count.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "marks")
# Least standard deviation of each feature. Most texts have no symbol and no repeated line, so
# their scatter alone would make any text that has one an outlier.
FLOORS = (0.5, 0.1, 0.35, 0.25, 0.25, 0.25, 0.35)
COVERAGE = 0.5  # share of a group that the estimate is concentrated on
STEPS = 6
REWEIGHT = 0.975  # share of clean rows that the final estimate uses
CUTOFF = 1 - 1e-4  # share of clean rows within the accepted distance, were they normal
BINS_PER_DOUBLING = 32
SENT_GROUPS = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_COUNTED = record(**{c: T.LongType() for c in (*COUNTS, "n_lines", "n_capitals", "n_marks")})

_BLANK_BYTES = BLANKS.encode()
_CAPITALS = bytes(range(65, 91))
_MARKS = bytes(b for b in range(33, 127) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_MIX = np.random.default_rng(7).integers(1, 1 << 62, WINDOW, dtype=np.int64).astype(np.uint64) * 2 + 1


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window which the text holds at least twice, its first place included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = sum(h[i : i + n] * _MIX[i] for i in range(WINDOW))
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(windows, twice).view(np.int8)
    return int(np.count_nonzero(np.convolve(starts, np.ones(WINDOW, np.int8))))


def _counts(raw: bytes) -> tuple[int, ...]:
    words = raw.split()
    without = len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    # Code points: bytes that do not continue a character.
    buffer = np.frombuffer(raw, np.uint8)
    points = int(np.count_nonzero((buffer & 0xC0) != 0x80))
    return (
        len(words),
        points - (without - len(raw.translate(None, _BLANK_BYTES))),
        without - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        without - len(raw.translate(None, _CAPITALS)),
        without - len(raw.translate(None, _MARKS)),
    )


@F.arrow_udf(_COUNTED)
@trimmed
def _text_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = np.array([_counts(raw.as_py()) for raw in batch], np.int64).reshape(-1, len(_COUNTED))
        columns = [pa.array(np.ascontiguousarray(c)) for c in rows.T]
        yield pa.StructArray.from_arrays(columns, names=_COUNTED.names)


def text_counts(text_col: str = "text") -> Column:
    """Counts of a whole text as a struct; null counts as empty."""
    return _text_counts(raw_text(text_col))


def _features(s: str) -> list[Column]:
    """The transformed statistics of the counts in column ``s``; finite for every text."""
    words = F.greatest(F.col(f"{s}.n_words"), F.lit(1))
    chars = F.greatest(F.col(f"{s}.word_chars"), F.lit(1))
    lines = F.greatest(F.col(f"{s}.n_lines"), F.lit(1))
    return [
        F.log(words),
        # Short texts say little about the length of words: counted with 20 usual words added.
        F.log((chars + 100) / (words + 20)),
        F.log1p(100 * F.col(f"{s}.n_symbols") / words) / 2,
        F.sqrt(F.col(f"{s}.n_dup_lines") / lines),
        F.sqrt(F.col(f"{s}.n_repeat_words") / words),
        F.sqrt(F.col(f"{s}.n_capitals") / chars),
        F.log1p(20 * F.col(f"{s}.n_marks") / chars),
    ]


def base_failed(s: str) -> Column:
    """The fixed limits: too few words, or too many of them in repeated windows."""
    words = F.col(f"{s}.n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PCT * words)


def chi2_quantile(p: int, share: float) -> float:
    """The distance below which ``share`` of a chi-square variable with ``p`` degrees lies."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(p, mid) < share else (low, mid)
    return high


def chi2_share(p: int, x: float) -> float:
    """Lower regularised gamma function of p/2 at x/2, by its power series."""
    a, y = p / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1 / a
    k = 0
    while term > total * 1e-17 and k < 5000:
        k += 1
        term *= y / (a + k)
        total += term
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a)))


def _beside(estimates: DataFrame) -> DataFrame:
    """Kept estimates as the small side of a join: sent to all tasks up to a checked number.

    One takes about half a kilobyte, so they are 10 MB at most. Beyond, Spark joins by shuffle and
    splits hot groups.
    """
    return F.broadcast(estimates) if estimates.count() <= SENT_GROUPS else estimates


def _levels(lang: Column, source: Column) -> list[Column]:
    """Group names from the narrowest to all texts; a missing value is a value of its own."""
    lang, source = F.to_json(F.array(lang)), F.to_json(F.array(source))
    return [F.concat(F.lit("source "), lang, source), F.concat(F.lit("lang "), lang), F.lit("all")]


def _distance(x: list[Column], center: str, precision: str) -> Column:
    """Squared Mahalanobis distance; the precision is a row-wise square matrix in an array."""
    p = len(x)
    d = [x[i] - F.get(F.col(center), F.lit(i)) for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        row = sum((F.get(F.col(precision), F.lit(i * p + j)) * d[j] for j in range(i)), F.lit(0.0))
        total += d[i] * (2 * row + F.get(F.col(precision), F.lit(i * p + i)) * d[i])
    return F.greatest(total, F.lit(0.0))


_ESTIMATE = record(
    grp=T.StringType(),
    n=T.LongType(),
    center=T.ArrayType(T.DoubleType()),
    precision=T.ArrayType(T.DoubleType()),
)


def _concentrated(p: int, share: float | None, scale: float, floors: tuple[float, ...]):
    """The function that turns one group's moments per distance bin into an estimate.

    Bins are taken from the centre outwards until they hold ``share`` of the rows, of the last one
    only the part that is missing, so equal rows never enter beyond the share; all bins when it
    is None. A group has at most a few thousand bins, whatever its size.
    """
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]

    def estimate(bins: pa.Table) -> pa.Table:
        bins = bins.sort_by("bin")
        n = bins["n"].to_numpy()
        total = int(n.sum())
        part = np.ones(len(n))
        if share is not None:
            part = np.clip((math.ceil(share * total) - (np.cumsum(n) - n)) / n, 0.0, 1.0)
        moments = part @ np.array(bins["moments"].to_pylist(), np.float64)
        m = float(part @ n)
        center = moments[:p] / m
        cov = np.zeros((p, p))
        for k, (i, j) in enumerate(pairs):
            cov[i, j] = cov[j, i] = moments[p + k] / m - center[i] * center[j]
        precision = np.linalg.inv(_floored(cov * scale, floors))
        row = {
            "grp": bins["grp"][0].as_py(),
            "n": total,
            "center": center.tolist(),
            "precision": precision.ravel().tolist(),
        }
        return pa.Table.from_pylist([row])

    return estimate


def _floored(cov: np.ndarray, floors: tuple[float, ...]) -> np.ndarray:
    """The scatter with no direction narrower than the floors, which also makes it invertible."""
    f = np.array(floors)
    values, vectors = np.linalg.eigh(cov / np.outer(f, f))
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * np.outer(f, f)


def fit_outliers(vectors: DataFrame, features: tuple[str, ...], floors: tuple[float, ...]) -> DataFrame:
    """Robust estimates (grp, n, center, precision) from rows of ``grp`` and feature columns.

    Starts at the medians and median deviations of rounded features, whose distinct values are
    few, then concentrates: each step bins the rows of a group by distance, sums counts and
    moments per bin in the scanning tasks, and fits the nearest ``COVERAGE`` of the group anew.
    All rows take part in each step; only bins of groups meet in a task.
    """
    p = len(features)
    rounded = [F.round(F.col(c) * 64) / 64 for c in features]
    medians = vectors.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.median(c) for c in rounded]).alias("center")
    )
    spread = [F.median(F.abs(c - F.get(F.col("center"), F.lit(i)))) for i, c in enumerate(rounded)]
    deviations = [F.greatest(1.4826 * s, F.lit(floors[i])) for i, s in enumerate(spread)]
    start = (
        vectors.join(_beside(settled(medians)), "grp")
        .groupBy("grp", "n", "center")
        .agg(F.array(*deviations).alias("s"))
    )
    diagonal = [
        F.pow(F.get(F.col("s"), F.lit(i)), F.lit(-2.0)) if i == j else F.lit(0.0)
        for i in range(p)
        for j in range(p)
    ]
    found = settled(start.select("grp", "n", "center", F.array(*diagonal).alias("precision")))

    x = [F.col(c) for c in features]
    products = [x[i] * x[j] for i in range(p) for j in range(i + 1)]
    moments = F.array(*[F.sum(c) for c in (*x, *products)]).alias("moments")
    bin_of = F.floor(F.log2(F.col("d2") + 1e-9) * BINS_PER_DOUBLING).cast("int").alias("bin")

    def step(found: DataFrame, share: float | None, scale: float, within: float | None) -> DataFrame:
        known = _beside(found.select("grp", "center", "precision"))
        near = vectors.join(known, "grp").select(
            "grp", *features, _distance(x, "center", "precision").alias("d2")
        )
        if within is not None:
            near = near.filter(F.col("d2") <= within)
        bins = near.groupBy("grp", bin_of).agg(F.count(F.lit(1)).alias("n"), moments)
        estimate = _concentrated(p, share, scale, floors)
        return settled(bins.groupBy("grp").applyInArrow(estimate, _ESTIMATE))

    # A normal cloud's nearest share has a smaller scatter than the cloud, by a known factor.
    inner = COVERAGE / chi2_share(p + 2, chi2_quantile(p, COVERAGE))
    for _ in range(STEPS):
        found = step(found, COVERAGE, inner, None)
    outer = chi2_quantile(p, REWEIGHT)
    last = step(found, None, REWEIGHT / chi2_share(p + 2, outer), outer)
    return last.drop("n").join(found.select("grp", "n"), "grp")


def _shrunk(p: int):
    """The function that draws the estimates of each row's levels toward the wider ones.

    The weight of a group of n is n / (n + p) for its centre and n / (n + the number of centre and
    scatter values) for its scatter: no number of texts switches from one estimate to another. The
    square of the step that the centre was drawn is added to the scatter.
    """
    values = p * (p + 3) / 2

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                center = None
                for e in (row["e2"], row["e1"], row["e0"]):
                    if e is None:
                        continue
                    own = np.array(e["center"])
                    scatter = np.linalg.inv(np.array(e["precision"]).reshape(p, p))
                    if center is None:
                        center, cov = own, scatter
                        continue
                    n = e["n"]
                    drawn = (center - own) * p / (n + p)
                    cov = (n * scatter + values * cov) / (n + values) + np.outer(drawn, drawn)
                    center = own + drawn
                if center is not None:
                    precision = np.linalg.inv(cov).ravel().tolist()
                    rows.append({"grp": row["l0"], "center": center.tolist(), "precision": precision})
            schema = pa.schema([("grp", pa.string()), *[(c, pa.list_(pa.float64())) for c in ("center", "precision")]])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return shrink


def fit(counted: DataFrame, s: str, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Estimates per (lang, source): (grp, center, precision), grp being the narrowest group.

    ``counted`` holds the counts in column ``s``. Texts that fail the fixed limits are left out.
    Every group has its own estimate, drawn toward its language's and that toward the one of all
    texts, by less the more texts it has.
    """
    levels = _levels(F.col(lang_col), F.col(source_col))
    x = _features(s)
    rows = counted.filter(~base_failed(s)).select(
        *[level.alias(f"l{i}") for i, level in enumerate(levels)],
        *[c.alias(name) for c, name in zip(x, FEATURES)],
    )
    vectors = rows.select(
        F.explode(F.array("l0", "l1", "l2")).alias("grp"), *FEATURES
    )
    found = settled(fit_outliers(vectors, FEATURES, FLOORS))
    out = settled(rows.select("l0", "l1", "l2").distinct())
    for i in range(3):
        level = found.select(F.col("grp").alias(f"l{i}"), F.struct("n", "center", "precision").alias(f"e{i}"))
        out = out.join(level, f"l{i}", "left")
    known = T.StructType([_ESTIMATE[c] for c in ("grp", "center", "precision")])
    return settled(out.select("l0", "e0", "e1", "e2").mapInArrow(_shrunk(len(FEATURES)), known))


def judge(
    counted: DataFrame, s: str, estimates: DataFrame, lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``counted`` with ``base_failed``, ``distance`` (null where no estimate exists) and ``kept``."""
    grp, center, precision = free_names(counted, "_grp", "_center", "_precision")
    known = estimates.select(
        F.col("grp").alias(grp), F.col("center").alias(center), F.col("precision").alias(precision)
    )
    level = _levels(F.col(lang_col), F.col(source_col))[0]
    joined = counted.withColumn(grp, level).join(_beside(known), grp, "left")
    distance = _distance(_features(s), center, precision)
    limit = chi2_quantile(len(FEATURES), CUTOFF)
    near = F.coalesce(F.col("distance"), F.lit(0.0)) <= math.sqrt(limit)
    # One condition that needs the estimates: of two joined by "and", a filter on the first would
    # be moved before the join, where it counts every text once more in a Python worker of its own.
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(near)
    return (
        joined.withColumns({"base_failed": base_failed(s), "distance": F.sqrt(distance)})
        .withColumn("kept", kept)
        .drop(grp, center, precision)
    )


def with_counts(docs: DataFrame, s: str, text_col: str = "text") -> DataFrame:
    return in_small_batches(docs).withColumn(s, text_counts(text_col))


def assess(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row's columns but the text, with its counts, ``base_failed``, ``distance``, ``kept``.

    Null text has no words and fails the fixed limits. Null languages and sources are groups of
    their own. Repeated rows count as often as they occur. Output names replace input columns. An
    empty table gives an empty table. The counts are kept without the texts, so each text is
    read once.
    """
    (s,) = free_names(docs, "_counts")
    counted = settled(with_counts(docs, s, text_col).drop(text_col))
    judged = judge(counted, s, fit(counted, s))
    return judged.withColumns({c: F.col(f"{s}.{c}") for c in COUNTS}).drop(s)


def keep_clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged.

    The texts are counted once for the estimates and once more where they are judged: that is a
    narrow stage, and cheaper than shuffling the texts to join their verdicts.
    """
    aside, restored = put_aside(docs, ["base_failed", "distance", "kept"])
    (s,) = free_names(aside, "_counts")
    slim = with_counts(aside, s, text_col).select("lang", "source", s)
    estimates = fit(settled(slim), s)
    return judge(with_counts(aside, s, text_col), s, estimates).filter("kept").select(*restored)
