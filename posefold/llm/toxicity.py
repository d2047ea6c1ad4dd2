"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length.

Folding undoes compatibility forms, letter case, look-alike letters of other scripts and digits or signs
that stand for letters. Lexicon terms are words, and stems that begin several words. Their weights, lower
bounds of log rate ratios between toxic and clean rows, come from all labelled training rows. Phrases in which
terms occur as often in clean rows are exceptions: the same automaton finds them, and they excuse the terms
inside. A text is scored by the weights of its distinct matched words, as such and a word of its length.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posefold.llm.common import slices, stage, text_or_empty

THRESHOLD = 0.5
FOLDS = 5
THIRDS = 3
FIT_ROWS = 20_000
BROADCAST_LABELS = 500_000
#: Lengths of stems.
STEMS = range(4, 9)
#: A term is in so many toxic rows, and in this share of them.
MIN_ROWS, MIN_SHARE = 3, 0.003
#: A stem that owes more of its words than this to one longer term is left to that term.
MAX_SHARE = 0.8
#: Standard errors that a weight stays below its log ratio, and the least weight.
DOUBT, MIN_WEIGHT = 2.0, 1.0
#: Clean rows that make a phrase an exception.
EXCEPTION_ROWS = 3
#: Bounds of what the fit holds: terms in most toxic rows, phrases in most clean rows.
MAX_TERMS, MAX_EXCEPTIONS = 200_000, 20_000
MAX_HELD = 500_000

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ɑ": "a",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

_LOOKS = re.compile("[" + "".join(LOOKALIKES) + INVISIBLE + "]")
_SIGNS = re.compile("[" + re.escape("".join(SIGNS)) + r"]+(?=[^\W\d_])")
_SIGN_TABLE = str.maketrans(SIGNS)
_WORDS = re.compile(r"[^\W\d_]+")
_matchers: dict[str, Matcher] = {}


def _letters(found: re.Match) -> str:
    """Signs before a letter are letters themselves inside a word, or at its start."""
    before = found.string[found.start() - 1 : found.start()]
    stands = not before or before.isalpha() or before.isspace()
    return found[0].translate(_SIGN_TABLE) if stands else found[0]


def folded_words(text: str) -> list[str]:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
        text = _LOOKS.sub(lambda m: LOOKALIKES.get(m[0], ""), text)
    else:
        text = text.lower()
    return _WORDS.findall(_SIGNS.sub(_letters, text))


def terms_of(word: str) -> list[str]:
    """The terms that match a word: itself between spaces, and its stems after one."""
    return [f" {word} ", *(f" {word[:k]}" for k in STEMS if k <= len(word))]


class Matcher:
    """Aho-Corasick automaton of terms and exceptions over words joined by spaces."""

    def __init__(self, weights: dict[str, float], exceptions: list[str]) -> None:
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.automaton.add_word(term, (len(term), weight, False))
        for phrase in exceptions:
            held = self.automaton.get(phrase, (len(phrase), 0.0, False))
            self.automaton.add_word(phrase, (held[0], held[1], True))
        self.ready = bool(len(self.automaton))
        if self.ready:
            self.automaton.make_automaton()

    def hits(self, words: list[str], excuse: bool = True) -> dict[int, tuple[str, float]]:
        """``start: (word, weight)`` of the matched words in the joined text; the best term of each counts."""
        if not (self.ready and words):
            return {}
        text = f" {' '.join(words)} "
        found: dict[int, tuple[str, float]] = {}
        excused = set()
        for end, (length, weight, exception) in self.automaton.iter(text):
            start = end - length + 1
            if weight > (found[start][1] if start in found else 0.0):
                found[start] = (text[start + 1 : text.index(" ", start + 1)], weight)
            if exception and excuse:
                at = start
                while at < end:
                    excused.add(at)
                    at = text.index(" ", at + 1)
        return {start: hit for start, hit in found.items() if start not in excused}

    def total(self, words: list[str]) -> float:
        return sum(dict(self.hits(words).values()).values())


def matcher_of(model: dict, name: str) -> Matcher:
    """The automaton of one lexicon of the model, built once per worker."""
    key = f"{model['key']}:{name}"
    if key not in _matchers:
        if len(_matchers) > 16:
            _matchers.clear()
        _matchers[key] = Matcher(model["lexicons"][name], model["exceptions"])
    return _matchers[key]


def weights_of(terms: list[str], toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> dict[str, float]:
    """Lower bounds of the log rate ratios that are high enough, of terms not owed to a longer one."""
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    bound = ratio - DOUBT * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    longest = defaultdict(int)
    for term, n in zip(terms, toxic.tolist()):
        for stem in terms_of(term.strip())[1:] if term.endswith(" ") else (term[:k] for k in range(5, len(term))):
            longest[stem] = max(longest[stem], n)
    return {
        term: float(bound[i])
        for i, term in enumerate(terms)
        if bound[i] >= MIN_WEIGHT and (term.endswith(" ") or longest[term] <= MAX_SHARE * toxic[i])
    }


def traits(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.log1p(total), np.log1p(100 * total / (words + 10)), np.ones(len(total))], axis=1)


def logistic(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic model with a light penalty, by Newton steps."""
    theta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(theta))
        step = np.clip(np.linalg.solve(hessian, x.T @ (toxic - p) - 0.1 * theta), -2, 2)
        theta += step
        if np.abs(step).max() < 1e-6:
            break
    return theta


def _toxic_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that hold each term, added up as far as a task may hold them."""
    held: Counter = Counter()
    for batch in slices(batches):
        for text in batch.column("body").to_pylist():
            held.update({term for word in set(folded_words(text)) for term in terms_of(word)})
            if len(held) > MAX_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], ["term", "n"])
                held = Counter()
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["term", "n"])


def _term_counts(terms):
    """Distinct words of every row that match each term, by class and third; place -1 holds all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {term: i for i, term in enumerate(terms.value)}
        total = np.zeros((2, THIRDS, len(places) + 1), dtype=np.int64)
        for batch in slices(batches):
            for text, toxic, third in zip(*(batch.column(c).to_pylist() for c in ("body", "toxic", "third"))):
                words = set(folded_words(text))
                found = [places[t] for w in words for t in terms_of(w) if t in places]
                at, times = np.unique(np.array(found, dtype=np.int64), return_counts=True)
                total[int(toxic), third, at] += times
                total[int(toxic), third, -1] += len(words)
        toxic, third, at = np.nonzero(total)
        columns = [pa.array(np.where(at == len(places), -1, at), pa.int32()), pa.array(toxic, pa.int32()), pa.array(third, pa.int32()), pa.array(total[toxic, third, at])]
        yield pa.RecordBatch.from_arrays(columns, ["place", "toxic", "third", "n"])

    return run


def _phrases(model):
    """Rows of either class that hold each phrase around a matched word, and the word where a stem matched it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(model.value, "whole")
        held: Counter = Counter()
        for batch in slices(batches):
            for text, toxic in zip(batch.column("body").to_pylist(), batch.column("toxic").to_pylist()):
                words = folded_words(text)
                hits = matcher.hits(words, excuse=False)
                if not hits:
                    continue
                at, found = 0, set()
                for i, word in enumerate(words):
                    if at in hits:
                        if f" {word} " not in model.value["lexicons"]["whole"]:
                            found.add(f" {word} ")
                        if i:
                            found.add(f" {words[i - 1]} {word} ")
                        if i + 1 < len(words):
                            found.add(f" {word} {words[i + 1]} ")
                    at += len(word) + 1
                held.update((phrase, bool(toxic)) for phrase in found)
                if len(held) > MAX_HELD:
                    yield _phrase_batch(held)
                    held = Counter()
        yield _phrase_batch(held)

    return run


def _phrase_batch(held: Counter) -> pa.RecordBatch:
    phrases, toxic = zip(*held) if held else ((), ())
    n = np.array(list(held.values()), dtype=np.int64)
    bad = np.array(toxic, dtype=bool)
    columns = [pa.array(phrases, pa.string()), pa.array(np.where(bad, n, 0)), pa.array(np.where(bad, 0, n))]
    return pa.RecordBatch.from_arrays(columns, ["phrase", "toxic", "clean"])


def train(documents: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, fit_rows: int) -> dict:
    """The model: lexicons without each third and of all rows, exceptions, and the logistic's weights."""
    spark = documents.sparkSession
    known = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
        .where(F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS != 0)
        .groupBy(F.col(id_column).alias("id"))
        .agg((F.avg(label_column) >= 0.5).alias("toxic"))
        .withColumn("third", F.pmod(F.xxhash64("id", F.lit("third")), F.lit(THIRDS)).cast("int"))
    )
    known = stage(known, "toxic-labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        good = sizes.get(True, 0)
        score = (good + 1) / (sum(sizes.values()) + 2)
        return {"key": "none", "lexicons": {"whole": {}}, "exceptions": [], "theta": np.array([0.0, 0.0, np.log(score / (1 - score))])}
    if sum(sizes.values()) <= BROADCAST_LABELS:
        known = F.broadcast(known)  # an id, a flag and a digit each, counted
    rows = documents.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("body")).join(known, "id")

    # Terms of enough toxic rows. A share bounds their number by that of the terms of a row, whatever the input.
    least = max(MIN_ROWS, int(MIN_SHARE * sizes[True]))
    summed = rows.where("toxic").select("body").mapInArrow(_toxic_terms, "term string, n bigint")
    summed = summed.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    terms = sorted(r["term"] for r in summed.orderBy(F.desc("n"), "term").limit(MAX_TERMS).select("term").collect())
    shared = spark.sparkContext.broadcast(terms)
    counted = rows.select("body", "toxic", "third").mapInArrow(_term_counts(shared), "place int, toxic int, third int, n bigint")
    counted = counted.groupBy("place", "toxic", "third").agg(F.sum("n").alias("n"))
    total = np.zeros((2, THIRDS, len(terms) + 1))
    for r in counted.collect():  # six numbers a term at most
        total[r["toxic"], r["third"], r["place"]] = r["n"]
    lexicons = {}
    for third in (*range(THIRDS), None):
        inside = [k for k in range(THIRDS) if k != third]
        clean, toxic = total[:, inside].sum(axis=1)
        name = "whole" if third is None else str(third)
        lexicons[name] = weights_of(terms, toxic[:-1], clean[:-1], toxic[-1], clean[-1])
    model = {"key": f"{spark.sparkContext.applicationId}-{id(lexicons)}-{len(terms)}", "lexicons": lexicons, "exceptions": []}

    drafted = spark.sparkContext.broadcast(model)
    phrases = rows.select("body", "toxic").mapInArrow(_phrases(drafted), "phrase string, toxic bigint, clean bigint")
    phrases = phrases.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rate = (F.col("clean") + 0.5) / (sizes[False] + 1) >= (F.col("toxic") + 0.5) / (sizes[True] + 1)
    common = phrases.where((F.col("clean") >= EXCEPTION_ROWS) & rate).orderBy(F.desc("clean"), "phrase").limit(MAX_EXCEPTIONS)
    model = {**model, "key": model["key"] + "-excused", "exceptions": [r["phrase"] for r in common.select("phrase").collect()]}

    excused = spark.sparkContext.broadcast(model)
    sample = known.select("id", F.xxhash64("id", F.lit("fit")).alias("draw")).orderBy("draw", "id").limit(fit_rows)
    chosen = rows.join(F.broadcast(sample.select("id")), "id", "left_semi")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = [folded_words(text) for text in batch.column("body").to_pylist()]
            found = [matcher_of(excused.value, str(k)).total(w) for w, k in zip(held, batch.column("third").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.float64()), pa.array(map(len, held), pa.int64())], ["toxic", "total", "words"])

    # Each row by the lexicon of the other thirds.
    fit = chosen.select("body", "toxic", "third").mapInArrow(totals, "toxic boolean, total double, words bigint").toPandas()
    fit = fit.sort_values(["total", "words", "toxic"])
    model["theta"] = logistic(traits(fit.total.to_numpy(), fit.words.to_numpy(dtype=float)), fit.toxic.to_numpy(dtype=float))
    return model


def scores_of(texts: list[str], model: dict) -> np.ndarray:
    matcher = matcher_of(model, "whole")
    held = [folded_words(text) for text in texts]
    x = traits(np.array([matcher.total(words) for words in held], dtype=float), np.array([len(words) for words in held], dtype=float))
    return 1 / (1 + np.exp(-np.clip(x @ model["theta"], -35, 35)))


def score_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    threshold: float = THRESHOLD,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per document: ``id, held_out, score, predicted``.

    Rows whose ``crc32(id as text) mod 5`` is 0 are held out: their labels are never looked at. Scores
    see the text alone, all of it. A null text counts as empty and is scored like any other; null ids are
    scored, held out and never train; a label that is null is none, labels that repeat an id are averaged. With
    labels of one class or none every score is a constant. An empty table gives no rows. Other columns
    are not looked at, whatever their names. Term and phrase counts cover all labelled rows of the other
    folds; ``fit_rows`` bounds the rows whose totals fit the logistic model.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels, id_column, text_column, label_column, fit_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = scores_of(batch.column("body").to_pylist(), model.value)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.float64())], ["id", "score"])

    rows = documents.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("body"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(score, f"id {id_type}, score double").select(
        F.col("id").alias(id_column),
        (F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
