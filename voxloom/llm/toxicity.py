"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon has a fixed part, and a part that is learnt: words and word beginnings that stand
in many more texts of label 1 than of label 0. Lexicons are learnt from each half of the
training rows and from both. A training row gets its features from the lexicon of the other
half, so the trees see how far the lexicon holds for texts it has not seen; all other rows get
them from both.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import columns_from_text, settle, slices

# Abusive words, and words for the person spoken to.
LEXICON = frozenset(
    "arschloch asshole bastard bitch clown connard crap crétin cretin cunt damn depp disgusting dumb "
    "dumbass estúpido fool freak fuck garbage hate idiot idiota idiote imbécil imbécile imbecile jerk "
    "kill loser mierda moron müll pathetic pig pute retard salaud scum shit sick slut stupid stupide "
    "trash ugly vermin whore worthless".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
    "tú tu tus usted ustedes vosotros".split()
)
NEAR = 5  # words between an abusive word and the person spoken to
LOOKALIKE = str.maketrans("0134578@$!|€+", "oieastbasilet")

STRIP = "\"'`.,;:!?()[]{}<>|*#%&$-_=~/\\…«»„“”¡¿"
OBFUSCATED = re.compile(r"^[^\W\d_]+[\d@$!*|€+#%.\-_]+[^\W\d_]+$")
REPEATED = re.compile(r"(\w)\1{2,}")
SPLIT = re.compile(r"[@$!*|€+#%.\-_]")

FEATURES = (
    "lexicon_density", "lexicon_count", "lexicon_kinds", "near_second_person", "second_person",
    "capitals", "shouted_words", "exclamations", "questions", "punctuation",
    "obfuscated_words", "obfuscated_lexicon", "repeated_letters", "log_words",
)
LEARNT = ("learnt_density", "learnt_count", "learnt_kinds")
INPUTS = (*FEATURES, *LEARNT)

BEGINNING = 4  # letters
MIN_TEXTS, MIN_RATIO = 5, 20  # texts of label 1 with a term, and how much likelier it is there
MAX_TERMS = 2000  # of each learnt lexicon: those with the largest ratios
HALVES = (0, 1, 2)  # bits of a term: learnt from half 0, half 1, both

MAX_ITERATIONS, MAX_DEPTH = 20, 3
MAX_TRAINING_ROWS = 500_000  # labelled ids; beyond it a share of them by hash of the id
CALIBRATION_FOLD = 1  # of the folds that are learnt from, for isotonic regression


def terms_of(word: str) -> tuple[str, str]:
    """A word as the lexicon knows it, and its beginning."""
    return word, f"{word[:BEGINNING]}*"


def features(text: str | None, learnt: dict[str, int] | None = None) -> list[float]:
    """One number for each of FEATURES, then LEARNT once for each lexicon of HALVES; a text
    without words has zeros. learnt gives the lexicons (as bits) that hold a term."""
    raw = (text or "").split()
    n = len(raw)
    if not n:
        return [0.0] * (len(FEATURES) + len(LEARNT) * len(HALVES))
    hits, persons, hidden, odd, shouted = [], [], 0, 0, 0
    kinds = set()
    found: Counter = Counter()
    known = learnt.get if learnt else None
    for i, word in enumerate(raw):
        core = word.strip(STRIP)
        low = core.lower()
        if known and (bits := known(low, 0) | (known(f"{low[:BEGINNING]}*", 0) if len(low) > BEGINNING else 0)):
            found[low, bits] += 1
        if low in LEXICON:
            hits.append(i)
            kinds.add(low)
        elif low in SECOND_PERSON:
            persons.append(i)
        elif not low.isalpha() and OBFUSCATED.match(core):
            odd += 1
            plain = SPLIT.sub("", low.translate(LOOKALIKE))
            if plain in LEXICON or SPLIT.sub("", low) in LEXICON:
                hidden += 1
                hits.append(i)
                kinds.add(plain)
        if len(core) > 2 and core.isupper():
            shouted += 1
    near = sum(any(abs(h - p) <= NEAR for p in _around(persons, h)) for h in hits)
    body = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(body, minlength=128)
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    marks = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
    made = [
        len(hits) / n, float(np.log1p(len(hits))), float(np.log1p(len(kinds))), near / n, len(persons) / n,
        float(counts[65:91].sum()) / letters, shouted / n, float(counts[33]) / n, float(counts[63]) / n,
        marks / n, odd / n, hidden / n, sum(1 for _ in REPEATED.finditer(text)) / n, float(np.log1p(n)),
    ]
    for half in HALVES:
        own = [c for (_, bits), c in found.items() if bits >> half & 1]
        made += [sum(own) / n, float(np.log1p(sum(own))), float(np.log1p(len(own)))]
    return made


def _around(places: list[int], at: int) -> list[int]:
    i = int(np.searchsorted(places, at))
    return places[max(0, i - 1) : i + 1]


def with_features(docs: DataFrame, text: str, learnt: dict[str, int]) -> DataFrame:
    def make():
        return lambda texts: list(zip(*[features(t, learnt) for t in texts], strict=True))

    names = [*FEATURES, *[f"{f}_{half}" for half in HALVES for f in LEARNT]]
    return columns_from_text(docs, text, ", ".join(f"{f} double" for f in names), make)


def learnt_lexicons(labelled: DataFrame) -> dict[str, int]:
    """Terms and the lexicons that hold them (bits), from rows of _text, label and half.

    Every given row counts. Tasks count terms and emit sums, so what is shuffled is a row for each
    term and slice of texts; at most MAX_TERMS terms a lexicon reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 16 << 20):
                sums: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
                for text, label, half in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    words = {w.strip(STRIP).lower() for w in (text or "").split()}
                    terms = {t for w in words if len(w) > BEGINNING for t in terms_of(w)} | words
                    for term in terms | {""}:  # "" counts the texts, each once
                        sums[term][2 * half + int(label)] += 1
                if sums:
                    columns = [list(sums), *zip(*sums.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                        ["term", "z0", "o0", "z1", "o1"],
                    )

    schema = "term string, z0 bigint, o0 bigint, z1 bigint, o1 bigint"
    counted = labelled.select("_text", "label", "half").mapInArrow(count, schema)
    sums = settle(counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("z0", "o0", "z1", "o1")]))
    totals = sums.filter("term = ''").first()
    lexicons: dict[str, int] = defaultdict(int)
    if totals is None:
        return {}
    for half, zero, one in ((0, "z0", "o0"), (1, "z1", "o1"), (2, "z0 + z1", "o0 + o1")):
        zeros = totals["z0"] + totals["z1"] if half == 2 else totals[f"z{half}"]
        ones = totals["o0"] + totals["o1"] if half == 2 else totals[f"o{half}"]
        ratio = F.expr(f"({one}) * {max(zeros, 1)}D / ({max(ones, 1)}D * ({zero} + 1))")
        least = MIN_TEXTS if half == 2 else (MIN_TEXTS + 1) // 2
        kept = sums.filter((F.col("term") != "") & (F.expr(one) >= least) & (ratio >= MIN_RATIO))
        for r in kept.orderBy(ratio.desc(), "term").limit(MAX_TERMS).select("term").collect():
            lexicons[r["term"]] |= 1 << half
    return dict(lexicons)


def bounded_sample(labels: DataFrame, most: int) -> DataFrame:
    """All labels, a row for each _key, or a share of about so many by hash of the key.

    The hash has its own seed: the halves of learnt_lexicons use the plain one.
    """
    size = labels.count()
    if size <= most:
        return labels
    place = F.pmod(F.xxhash64(F.lit("sample"), "_key"), F.lit(1 << 30))
    return labels.filter(place < most * (1 << 30) // size)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    learn_from,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fold=None,
) -> DataFrame:
    """key, score (0 to 1), predicted (1 from 0.5) for each row of docs.

    The lexicon and the trees are fitted on at most about MAX_TRAINING_ROWS labelled ids. That
    bound allows their labels to be broadcast, so texts are read twice and never shuffled.
    Only rows for which learn_from (a column over key) is true give labels. Trees are grown on
    them, except those for which fold (a column over key) is true: these give the isotonic
    map from the trees' probability to the share of label 1. Null labels and labels without a
    document are left out; of several labels of an id the largest counts, of several texts of a
    labelled id that with the least features is learnt from (all are scored). Null texts are
    empty; they get a score like any other. If the labels have one class (or none), the score
    is that class (or 0) for all. Rows with a null key are scored too. Rows stay.
    """
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    held = fold(F.col("_key")) if fold is not None else F.lit(False)
    learn = learn_from(F.col("_key"))
    half = F.pmod(F.xxhash64("_key"), F.lit(2)).alias("half")
    named = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    truth = named.filter(F.col("_label").isNotNull() & F.col("_key").isNotNull() & learn)
    truth = truth.groupBy("_key").agg((F.max("_label") > 0).cast("double").alias("label"))
    truth = F.broadcast(bounded_sample(settle(truth), MAX_TRAINING_ROWS))
    labelled = narrow.filter(learn & ~held).join(truth, "_key")
    learnt = learnt_lexicons(labelled.select("_text", "label", half))
    known = settle(with_features(narrow, "_text", learnt).drop("_text"))
    everything = [F.col(f"{f}_2").alias(f) for f in LEARNT]
    # A row of one half is seen by the lexicon of the other.
    other = [
        F.when(held, F.col(f"{f}_2")).when(half == 0, F.col(f"{f}_1")).otherwise(F.col(f"{f}_0")).alias(f)
        for f in LEARNT
    ]
    pool = known.filter(learn).join(truth, "_key").select("_key", "label", *FEATURES, *other)
    # Of several texts of an id the one with the least features stands, so reruns agree.
    rest = [c for c in pool.columns if c != "_key"]
    pool = pool.groupBy("_key").agg(F.min(F.struct(*rest)).alias("_one")).select("_key", "_one.*")
    known = known.select("_key", *FEATURES, *everything)
    assembler = VectorAssembler(inputCols=list(INPUTS), outputCol="features")
    pool = settle(assembler.transform(pool))
    size, positives = pool.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not size or positives in (0, size):
        constant = float((positives or 0) / size) if size else 0.0
        score = F.lit(constant)
        return known.select(
            F.col("_key").alias(key), score.alias("score"), F.lit(int(constant >= 0.5)).alias("predicted")
        )
    grow = pool.filter(~held)
    if grow.filter("label = 1").isEmpty() or grow.filter("label = 0").isEmpty():
        grow = pool
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=MAX_ITERATIONS, maxDepth=MAX_DEPTH,
        stepSize=0.2, seed=1, minInstancesPerNode=2, maxMemoryInMB=64,
    ).fit(grow)

    def with_probability(df):
        judged = trees.transform(df)
        return judged.withColumn("_raw", vector_to_array("probability")[1])

    bent = with_probability(pool.filter(held)).select("_raw", "label")
    if bent.filter("label = 1").isEmpty() or bent.filter("label = 0").isEmpty():
        bent = with_probability(pool).select("_raw", "label")
    curve = IsotonicRegression(featuresCol="_raw", labelCol="label", predictionCol="_even").fit(bent)
    judged = curve.transform(with_probability(assembler.transform(known)))
    # The map has steps; a thousandth of the trees' own probability orders the rows of a step.
    score = F.col("_even") * 0.999 + F.col("_raw") * 0.001
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
    return judged.select(
        F.col("_key").alias(key), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )
