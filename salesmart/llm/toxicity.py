"""Toxicity: gradient-boosted trees over dense features, calibrated isotonically.

Features of a text: densities of two lexicons (a short general one, and one
learned from the labels), their hits near second-person words, capitals,
punctuation, symbols and obfuscation (letters mixed with digits or signs,
stretched letters). Learning:

1. ``MAX_FIT_ROWS`` labelled documents (all, if fewer; the least by a hash of the
   id), none of the held-out fold, are written as the sample. This bound is the
   only one: everything is scored.
2. The learned lexicon: whole words and word beginnings of ``PREFIXES`` letters
   that more toxic than other documents hold, weighted by their log-odds. Document
   counts are kept by fold, so a labelled document's own features come from a
   lexicon learned without its fold; all others get the whole one.
3. Trees are fitted for each fold on the other folds, then on all; the margins of
   the documents left out are what the isotonic map learns from.

How it scales: scoring maps over rows, no shuffle. The sample's ids are broadcast
(at most ``MAX_FIT_ROWS``), lexicon counts are combined in each task, and the
driver fits on one row of ``FEATURES`` numbers for each sampled document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.boosting import Isotonic, Trees, fit_isotonic, fit_trees
from salesmart.llm.common import map_batches
from salesmart.session import scratch_uri

FOLDS = 5
HELD_OUT_FOLD = 0
#: Bound of the labelled sample that lexicon, trees and calibration are learned from.
MAX_FIT_ROWS = 40_000
#: Units looked at as lexicon entries (the most frequent in toxic documents), and units kept.
LEXICON_CANDIDATES = 50_000
LEXICON_SIZE = 400
MIN_TOXIC_SHARE = 0.005
MIN_TOXIC_DOCS = 3
MIN_LOG_ODDS = 1.0
PREFIXES = range(3, 7)
NEAR = 3
#: Share of the uncalibrated probability in the score: keeps the order inside a calibrated block.
RANK_SHARE = 0.01
GROUP_WORDS = 100_000
TABLE_WORDS = 300_000

# Common English insults, and second-person words of five languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless disgusting trash scum "
    "clown clowns garbage jerk fool fools imbecile ignorant ugly creep freak filth filthy vile "
    "coward cowards liar liars hate hateful shut kill die crap sucks suck hell damn bastard".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself you're youre ya u ur tu te toi ton ta tes vous votre vos du dich dir "
    "dein deine euch ihr sie usted ustedes ti tus vosotros lei voi tuo tua".split()
)
# Digits and signs that stand for letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")

_LETTER = re.compile(r"[^\W\d_]")
_INNER_SIGN = re.compile(r"(?<=[^\W\d_])[^\w\s'’\-]+(?=[^\W\d_])")
_INNER_DIGIT = re.compile(r"(?<=[^\W\d_])\d+(?=[^\W\d_])|(?<=[^\W\d_])\d|\d(?=[^\W\d_])")
_STRETCHED = re.compile(r"(\w)\1\1+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")

FEATURES = (
    "log_words learned_density learned_hits learned_top learned_weight insult_density insult_hits "
    "second_person near_hits capital_words capital_letters exclamations questions symbols "
    "other_punctuation obfuscated digits mean_letters"
).split()


def fold_of(doc_id: int | None) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


def core_of(token: str) -> tuple[str, bool]:
    """The word that a token spells, in lower case, and whether it was obfuscated."""
    word = _EDGES.sub("", token.lower())
    if word.isalpha():
        plain = word
        hidden = False
    else:
        plain = _INNER_SIGN.sub(lambda m: m[0].translate(LOOKALIKES) if m[0] in "@$!|" else "", word)
        hidden = plain != word
        if _LETTER.search(plain) and _INNER_DIGIT.search(plain):
            plain, hidden = plain.translate(LOOKALIKES), True
    short = _STRETCHED.sub(r"\1", plain)
    return short, hidden or short != plain


def units_of(word: str) -> list[str]:
    """Lexicon units of a word: itself (marked by a final space) and its beginnings."""
    if len(word) < 3 or not word[0].isalpha():
        return []
    return [word + " ", *(word[:k] for k in PREFIXES if k <= len(word))]


# --- features


class TokenTable(dict):
    """Token to the row of its properties, computed once for each token it holds."""

    COLUMNS = 12  # before the weights

    def __init__(self, lexicons: list[dict[str, float]]):
        super().__init__()
        self.lexicons = lexicons
        self.rows = np.zeros((0, self.COLUMNS + len(lexicons)), np.float32)
        self.fresh: list[tuple] = []

    def __missing__(self, token: str) -> int:
        body = token.rstrip(".,;:!?")
        if body.isalpha():  # a plain word, with its punctuation
            signs, letters, digits, symbols = token[len(body) :], len(body), 0, 0
            word = body.lower()
            upper = 0 if word == body else sum(map(str.isupper, body))
            plain = _STRETCHED.sub(r"\1", word)
            hidden, word = plain != word, plain
        else:
            word, hidden = core_of(token)
            letters = sum(map(str.isalpha, token))
            upper = sum(map(str.isupper, token))
            digits = sum(map(str.isdigit, token))
            signs = [c for c in token if not c.isalnum()]
            symbols = sum(c in "#*$%&|<>@^~=+" for c in signs)
        exclaim, ask = token.count("!"), token.count("?")
        units = units_of(word)
        self.fresh.append(
            (
                len(token),
                letters,
                upper,
                digits,
                exclaim,
                ask,
                symbols,
                len(signs) - symbols - exclaim - ask,
                letters > 1 and upper == letters,
                hidden,
                word in SECOND_PERSON,
                word in INSULTS,
                *[max([x.get(u, 0.0) for u in units], default=0.0) for x in self.lexicons],
            )
        )
        place = self[token] = len(self)
        return place

    def numbers(self, tokens: Iterator[str], count: int) -> np.ndarray:
        """Row numbers of the tokens; ``rows`` holds all of them afterwards."""
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, count)
        if self.fresh:
            self.rows = np.concatenate([self.rows, np.array(self.fresh, np.float32)])
            self.fresh = []
        return found

    def renewed(self) -> TokenTable:
        return TokenTable(self.lexicons) if len(self) > TABLE_WORDS else self


def features(texts: list[str | None], table: TokenTable, lexicon_of: np.ndarray) -> np.ndarray:
    """``FEATURES`` of each text, its learned weights from the lexicon of the given number."""
    parts = [text.split() if text else [] for text in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    flat = table.numbers(chain.from_iterable(parts), lengths.sum())
    starts = np.cumsum(lengths) - lengths
    some = lengths > 0
    rows = table.rows[flat]

    def total(values: np.ndarray) -> np.ndarray:
        """Sums over each text's words."""
        out = np.zeros((len(texts), *values.shape[1:]))
        if some.any():
            out[some] = np.add.reduceat(values, starts[some], axis=0, dtype=np.float64)
        return out

    sums = total(rows[:, : TokenTable.COLUMNS])
    chars, letters, upper, digits, exclaim, ask, symbols, other, caps, hidden, second, insults = sums.T
    if len(table.lexicons) == 1:
        weight = rows[:, TokenTable.COLUMNS]
    else:
        weight = rows[np.arange(len(flat)), TokenTable.COLUMNS + np.repeat(lexicon_of, lengths)]
    # few words are hits, and only they are looked at closer
    hits = np.flatnonzero((weight > 0) | (rows[:, 11] > 0))
    owner = np.searchsorted(starts + lengths, hits, side="right")
    weight = weight[hits]
    seen = np.cumsum(np.append(0, rows[:, 10]))
    low = np.maximum(hits - NEAR, starts[owner])
    high = np.minimum(hits + NEAR + 1, (starts + lengths)[owner])
    near = np.bincount(owner, seen[high] > seen[low], len(texts))
    top = np.zeros(len(texts))
    np.maximum.at(top, owner, weight)
    words = np.maximum(lengths, 1)
    learned = np.bincount(owner, weight > 0, len(texts))
    return np.stack(
        [
            np.log1p(lengths),
            learned / words,
            np.log1p(learned),
            top,
            np.bincount(owner, weight, len(texts)) / words,
            insults / words,
            np.log1p(insults),
            second / words,
            np.log1p(near),
            caps / words,
            upper / np.maximum(letters, 1),
            exclaim / np.maximum(chars, 1),
            ask / np.maximum(chars, 1),
            symbols / np.maximum(chars, 1),
            other / np.maximum(chars, 1),
            hidden / words,
            digits / np.maximum(chars, 1),
            letters / words,
        ],
        axis=1,
    ).astype(np.float32)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of some hundred rows with about ``GROUP_WORDS`` words of text, or one longer row."""
    for batch in batches:
        at, size = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy() // 6
        for k, n in enumerate(lengths.tolist()):
            size += n
            if size >= GROUP_WORDS or k - at >= 500:
                yield batch.slice(at, k + 1 - at)
                at, size = k + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


# --- the model


@dataclass(frozen=True)
class Model:
    """Learned lexicon, trees and calibration; without both classes a constant probability."""

    lexicon: dict[str, float] = field(default_factory=dict)
    trees: Trees | None = None
    calibration: Isotonic | None = None
    constant: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        margin = self.trees.margins(x)
        return (1 - RANK_SHARE) * self.calibration(margin) + RANK_SHARE / (1 + np.exp(-margin))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """``(doc_id, text, toxic)`` of at most ``max_rows`` labelled ids outside the held-out fold.

    An id that the labels repeat counts as toxic if any row says so; a null id or
    label is no label.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold != HELD_OUT_FOLD))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.join(F.broadcast(chosen), "doc_id")  # max_rows pairs of integers


def _unit_counts(sample: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """``(unit, fold, toxic, n)``: documents that hold a unit; ``wanted`` None: all of toxic ones."""
    schema = pa.schema(
        [("unit", pa.string()), ("fold", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: defaultdict[tuple, Counter] = defaultdict(Counter)
        known: dict[str, list[str]] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for (fold, toxic), units in counts.items():
                n = len(units)
                arrays = [list(units), [fold] * n, [toxic] * n, list(units.values())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(arrays, schema)], schema=schema
                )
            counts.clear()

        for batch in batches:
            for doc_id, text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                held: set[str] = set()
                for token in set(text.split()) if text else ():
                    units = known.get(token)
                    if units is None:
                        units = units_of(core_of(token)[0])
                        if wanted is not None:
                            units = [u for u in units if u in wanted]
                        if len(known) >= TABLE_WORDS:
                            known.clear()
                        known[token] = units
                    held.update(units)
                counts[fold_of(doc_id), toxic].update(held)
                if sum(map(len, counts.values())) > 500_000:
                    yield from emit()
        yield from emit()

    rows = map_batches(sample.select("doc_id", "text", "toxic"), run, "unit string, fold int, toxic int, n long")
    return rows.groupBy("unit", "fold", "toxic").agg(F.sum("n").alias("n"))


def weigh(units: list[str], counts: np.ndarray, totals: np.ndarray) -> dict[str, float]:
    """The lexicon from document counts (units x {0, 1}) and the numbers of documents {0, 1}."""
    if not len(units) or not totals.all():
        return {}
    clean, toxic = counts[:, 0] + 0.5, counts[:, 1] + 0.5
    odds = np.log(toxic / (totals[1] + 1)) - np.log(clean / (totals[0] + 1))
    spread = np.sqrt(1 / toxic + 1 / clean)
    order = np.lexsort((np.arange(len(units)), -odds / spread))
    enough = (odds >= MIN_LOG_ODDS) & (counts[:, 1] >= MIN_TOXIC_DOCS)
    chosen = [k for k in order.tolist() if enough[k]][:LEXICON_SIZE]
    return {units[k]: float(odds[k]) for k in chosen}


def learn(sample: DataFrame) -> Model:
    """The model of a written sample ``(doc_id, text, toxic)``."""
    per_fold = np.zeros((FOLDS, 2))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)).cast("int")
    for f, toxic, n in sample.groupBy(fold.alias("fold"), "toxic").count().collect():
        per_fold[f, toxic] = n
    totals = per_fold.sum(axis=0)
    if not totals.all():
        return Model(constant=float((totals[1] + 0.5) / (totals.sum() + 10)))

    least = max(MIN_TOXIC_DOCS, int(np.ceil(MIN_TOXIC_SHARE * totals[1])))
    candidates = (
        _unit_counts(sample.where("toxic = 1"), None)
        .groupBy("unit")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "unit")
        .limit(LEXICON_CANDIDATES)
        .toArrow()
    )
    units = sorted(candidates.column("unit").to_pylist())
    at = {u: k for k, u in enumerate(units)}
    counts = np.zeros((FOLDS, len(units), 2))
    if units:
        found = _unit_counts(sample, frozenset(units)).toArrow().to_pydict()
        place = [at[u] for u in found["unit"]]
        np.add.at(counts, (found["fold"], place, found["toxic"]), found["n"])
    whole = weigh(units, counts.sum(axis=0), totals)
    # number f: learned without fold f; nobody is of the held-out fold
    lexicons = [
        whole if f == HELD_OUT_FOLD else weigh(units, counts.sum(axis=0) - counts[f], totals - per_fold[f])
        for f in range(FOLDS)
    ]

    def factory():
        table = [TokenTable(lexicons)]

        def rows(part: pa.RecordBatch) -> pa.RecordBatch:
            ids = part.column("doc_id").to_pylist()
            folds = np.array([fold_of(i) for i in ids], np.int64)
            table[0] = table[0].renewed()
            x = features(part.column("text").to_pylist(), table[0], folds)
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("toxic"), pa.array([r.tobytes() for r in x], pa.binary())],
                names=["doc_id", "toxic", "x"],
            )

        return rows

    found = _mapped(sample, factory, "doc_id long, toxic int, x binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("x", "ascending")])
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, len(FEATURES))
    y = found.column("toxic").to_numpy().astype(np.float64)
    folds = np.array([fold_of(i) for i in found.column("doc_id").to_pylist()])
    margins = np.zeros(len(y))
    judged = np.zeros(len(y), np.bool_)
    for f in range(FOLDS):
        apart = folds == f
        if apart.any() and 0 < y[~apart].sum() < (~apart).sum():
            margins[apart] = fit_trees(x[~apart], y[~apart]).margins(x[apart])
            judged |= apart
    trees = fit_trees(x, y)
    if not judged.any():
        margins, judged = trees.margins(x), np.ones(len(y), np.bool_)
    return Model(whole, trees, fit_isotonic(margins[judged], y[judged]))


def _mapped(df: DataFrame, factory: Callable, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = factory()
        for part in _groups(batches):
            yield rows(part)

    return map_batches(df, run, schema)


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``SCORES`` of every row; ``predicted`` is 1 from score 0.5 on.

    A null text is an empty one and gets the score of a text without words; a null
    id is not held out; repeated rows are scored each; other columns are ignored;
    an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        held = [TokenTable([sent.value.lexicon])]

        def rows(part: pa.RecordBatch) -> pa.RecordBatch:
            ids = part.column("doc_id").to_pylist()
            held[0] = held[0].renewed()
            x = features(part.column("text").to_pylist(), held[0], np.zeros(len(ids), np.int64))
            s = sent.value.scores(x)
            return pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([fold_of(i) == HELD_OUT_FOLD for i in ids], pa.bool_()),
                    pa.array(s, pa.float64()),
                    pa.array((s >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

        return rows

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _mapped(source, factory, SCORES)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_fit_rows: int = MAX_FIT_ROWS,
) -> DataFrame:
    """``SCORES`` of every row of ``docs``, by a model of ``labels (doc_id, toxic)``.

    Labels of the held-out fold are never read; without labels of both classes every
    row gets one small constant. See ``score`` for other cases.
    """
    spark = docs.sparkSession
    path = scratch_uri(spark, "toxic-sample")
    sample = labelled_sample(docs, labels, id_col, text_col, max_fit_rows)
    sample.write.parquet(path)
    model = learn(spark.read.schema(sample.schema).parquet(path))
    return score(docs, model, id_col, text_col)
