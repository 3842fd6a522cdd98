"""Secret scans: a random forest removes the false positives of a wide candidate pattern.

Native operator: candidates, features, dictionary and forest are DataFrame expressions and the
DataFrame learning library; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of
from tidewater.sources.checkpoint import settled

MIN_CHARS = 16
CANDIDATE = rf"[A-Za-z0-9+/_=.\-]{{{MIN_CHARS},}}"
# Words of the dictionary: those of the most documents. A top-k list, so its size is bounded.
DICTIONARY_WORDS = 400
TREES, DEPTH, SEED = 40, 6, 11
THRESHOLD = 0.5

# Words beside a candidate that speak for or against a secret.
CREDENTIAL_WORDS = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private|credential|auth|bearer)"
SAMPLE_WORDS = r"(?i)(example|sample|dummy|placeholder|changeme|test|xxxx|your[_-])"
PATH_WORDS = r"(?i)(test|example|fixture|sample|mock|docs?/)"

FEATURES = (
    "length",
    "class_changes",
    "digit_share",
    "upper_share",
    "vowel_share",
    "hex_share",
    "distinct_share",
    "repeated_pairs",
    "dictionary_share",
    "separators",
    "quoted",
    "assigned",
    "credential_before",
    "sample_near",
    "path_sample",
    "word_before_length",
    "word_after_length",
)


def dictionary(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The lower-case words of 3 to 8 letters that most documents hold; ties by the word."""
    held = F.array_distinct(F.regexp_extract_all(text_of(text_col), F.lit(r"\b[a-z]{3,8}\b"), F.lit(0)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]


def find_candidates(
    docs: DataFrame,
    id_col: str = "doc_id",
    path_col: str | None = "source",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, word_no, part_no, candidate, word, before, after, path), a row per candidate.

    A candidate is a run of at least 16 key characters inside a word, words being what stands
    between white space; ``before`` holds the two words in front, ``after`` the one behind. The
    whole text is searched. Null texts have no candidate; null ids and paths stay null.
    """
    words = F.split(text_of(text_col), r"\s+")
    empty = F.array(F.lit(""))
    # The neighbours are zipped on, so that no lambda looks a word up by its place.
    zipped = F.arrays_zip(
        F.sequence(F.lit(0), F.size(words) - 1).alias("word_no"),
        words.alias("word"),
        F.concat(empty, words).alias("last"),
        F.concat(empty, empty, words).alias("last_but_one"),
        F.concat(F.slice(words, F.lit(2), F.size(words)), empty).alias("after"),
    )
    likely = F.filter(zipped, lambda w: w["word"].rlike(CANDIDATE))
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    places = (
        docs.filter(F.col(text_col).rlike(CANDIDATE))
        .select(F.col(id_col).alias("doc_id"), path.alias("path"), F.explode(likely).alias("w"))
        .select("doc_id", "path", "w.*")
    )
    parts = F.posexplode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0)))
    return places.select("*", parts.alias("part_no", "candidate")).select(
        "doc_id",
        "word_no",
        "part_no",
        "candidate",
        "word",
        F.concat_ws(" ", "last_but_one", "last").alias("before"),
        F.coalesce("after", F.lit("")).alias("after"),
        "path",
    )


def _share(c: Column, signs: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{signs}]", "")) / F.length(c)


def with_features(candidates: DataFrame, words: list[str]) -> DataFrame:
    """Candidates with one double column per feature; none is null."""
    c = F.col("candidate")
    low = F.lower(c)
    classes = F.regexp_replace(c, "[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", "x")
    # Longer words first, so that a word is covered whole.
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    uncovered = F.length(F.regexp_replace(low, known, ""))
    distinct = F.size(F.array_distinct(F.split(c, "")))
    pairs = F.length(c) - F.length(F.regexp_replace(c, r"(.)\1", "x"))
    found = {
        "length": F.length(c),
        "class_changes": (F.length(classes) - 1) / F.length(c),
        "digit_share": _share(c, "0-9"),
        "upper_share": _share(c, "A-Z"),
        "vowel_share": _share(c, "aeiouAEIOU"),
        "hex_share": _share(c, "0-9a-fA-F"),
        "distinct_share": distinct / F.length(c),
        "repeated_pairs": pairs / F.length(c),
        "dictionary_share": 1 - uncovered / F.length(c),
        "separators": _share(c, r"/._\-"),
        "quoted": F.col("word").rlike("[\"'`]").cast("int"),
        "assigned": F.concat_ws(" ", "before", "word").rlike("[=:]\\s*[\"'`]?\\S*$").cast("int"),
        "credential_before": F.concat_ws(" ", "before", "word").rlike(CREDENTIAL_WORDS).cast("int"),
        "sample_near": F.concat_ws(" ", "before", "word", "after").rlike(SAMPLE_WORDS).cast("int"),
        "path_sample": F.coalesce(F.col("path").rlike(PATH_WORDS), F.lit(False)).cast("int"),
        "word_before_length": F.length(F.substring_index("before", " ", -1)),
        "word_after_length": F.length("after"),
    }
    return candidates.withColumns({name: found[name].cast("double") for name in FEATURES})


def fit_forest(findings: DataFrame, label_col: str = "label") -> PipelineModel | None:
    """A forest over labelled findings with feature columns; none without both labels.

    Null labels are left out. The library trains on the cluster: tasks send sums per tree node.
    """
    labelled = settled(
        findings.select(*FEATURES, F.col(label_col).cast("double").alias("label")).dropna()
    )
    kinds = labelled.agg(F.count_if(F.col("label") > 0), F.count_if(F.col("label") == 0)).first()
    if not all(kinds):
        return None
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    )
    return Pipeline(stages=[assembler, forest]).fit(labelled)


def score_findings(findings: DataFrame, forest: PipelineModel | None) -> DataFrame:
    """Findings with ``score``, the forest's share for a real secret; 1 without a forest."""
    if forest is None:
        return findings.withColumn("score", F.lit(1.0))
    scored = forest.transform(findings)
    score = F.get(vector_to_array(F.col("probability")), F.lit(1))
    return scored.withColumn("score", score).drop("vector", "rawPrediction", "probability", "prediction")


def scan(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    path_col: str | None = "source",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, word_no, part_no, candidate, score, kept), a row per candidate of ``docs``.

    ``labelled`` holds labelled findings: the key (doc_id, word_no, part_no) of candidates and a
    0/1 ``label``. The forest learns from them and scores every candidate; those below 0.5 are
    false positives and not kept. Without labels of both kinds all are kept. Repeated documents
    give repeated findings; a finding labelled twice counts twice. Other columns play no part. An
    empty table gives an empty table.
    """
    words = dictionary(docs, text_col)
    found = settled(with_features(find_candidates(docs, id_col, path_col, text_col), words))
    key = ["doc_id", "word_no", "part_no"]
    forest = fit_forest(found.join(labelled.select(*key, "label"), key))
    scored = score_findings(found, forest)
    return scored.select(*key, "candidate", "score", (F.col("score") >= THRESHOLD).alias("kept"))


def labelled_by_form(candidates: DataFrame) -> DataFrame:
    """Labels for findings whose form alone decides: (doc_id, word_no, part_no, label).

    A hexadecimal digest of 32, 40 or 64 digits, quoted and given to a credential's name, is a
    secret; candidates of letters only, of digits only and mail addresses are not. Others have no
    label.
    """
    near = F.concat_ws(" ", "before", "word")
    digest = F.col("candidate").rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$")
    secret = digest & near.rlike(CREDENTIAL_WORDS) & F.col("word").rlike("[\"'`]")
    plain = F.col("candidate").rlike(r"^(?:[A-Za-z.\-]+|[0-9.\-]+)$") | F.col("word").contains("@")
    label = F.when(secret, 1).when(plain, 0)
    return candidates.select("doc_id", "word_no", "part_no", label.alias("label")).filter("label IS NOT NULL")
