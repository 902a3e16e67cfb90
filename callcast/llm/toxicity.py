"""Toxicity by a weighted finite-state pattern grammar.

A text is read as tokens.  The lexical transducer turns a token into a symbol
with a weight: ``I`` insult, ``H`` threat, ``Y`` target, ``N`` negation, ``S``
verb of speech, ``Q`` quote mark, ``C`` end of a clause, ``E`` end of a sentence;
every other token is read without a symbol.  Four transducers over these symbols
are composed into one:

* negation: an insult or threat after ``N`` in the same clause is negated;
* reported speech: after ``S``, up to the end of the sentence, or up to the closing
  quote mark if one was opened, an insult or threat is reported;
* target: an insult in the same sentence as ``Y`` (before or after) is aimed;
* threat: ``H`` counts only with ``Y`` in the same clause.

Arc weights add up along a path, in the log domain.  A matched insult or threat
counts its own weight times exp(arc weights), so clauses are scored, not words:
"you are no X" and "he said X" weigh less than "X you".

*Learning.*  Insults are learnt from labelled texts, with no word list: a term is
a whole word or a stem (a word's first 3 to 8 letters, whatever follows) whose
smoothed log odds between texts with label 1 and 0 reach ``min_odds`` and that
``min_docs`` texts with label 1 hold, beyond chance: of all terms tested,
``by_chance`` are expected to pass by luck.  A stem is taken only if it explains a tenth
more of these texts than any one longer term that begins with it, and then stands
for all of them.  The log odds are a term's weight.  To keep groups of near copies from
teaching their words, texts of one label that share the smallest hash of their
five-word shingles count once.  A logistic function over the match weights and the
length then gives the score.

The classifier is fitted on a bounded sample: about ``sample_per_label`` labelled
texts of each label (all, if fewer), drawn by a hash of the id; ``max_terms`` bounds
the lexicon, so the model that is sent to every task has a proven size.  Scores
cover every row and whole texts.

Defined results: null and empty texts, and texts without a match, get the score of
a text of that length without a match.  Without labels of both kinds nothing is
learnt: the score is 0.  An id that several label rows name has label 1 if one of
them says so; null ids and null labels are not learnt.  Repeated rows score alike;
an empty table gives an empty result.  Input columns that clash with the result
columns are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcast.llm.textops import shingle_set
from callcast.session import materialize, ship_package

TOKEN = re.compile(r"\w+|[.!?\n,;:\"“”„«»]")
STEM_SIZES = range(3, 9)
_CACHE = 1 << 20

# Cue words of the grammar.
TARGETS = "you your yours yourself u ya du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti tus usted ustedes vosotros".split()
NEGATIONS = "not never no nobody isn aren wasn nicht kein keine nie niemand pas jamais aucun ni nunca jamás nadie".split()
SPEECH = "said says say wrote writes called calls claimed claims told reported quoted sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()
THREATS = "kill killed murder hurt destroy shoot stab strangle umbringen töten erschießen verprügeln tuer tuerai frapper matar mataré golpear".split()
THREAT_WEIGHT = 3.0
QUOTES, CLAUSE, SENTENCE = "\"“”„«»", ",;:", ".!?\n"
# End of fixed values.

#: Log factors of the contexts (parameters of the grammar).
NEGATED, REPORTED, AIMED, LOOSE_THREAT = -2.0, -1.0, 0.5, -4.0

TAGS = "IHYNSQCE"
#: Symbols of matches: insult and threat, plain (I, H), negated (i, h), reported (J, G), negated and reported (j, g).
_MATCHES = ("I", "H", "i", "h", "J", "G", "j", "g")


@dataclass
class Transducer:
    """A deterministic weighted transducer; a symbol without an arc passes unchanged, with weight 0."""

    arcs: dict = field(default_factory=dict)  # (state, symbol) -> (symbol out, weight, next state)
    start: object = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (symbol, 0.0, state))


def compose(a: Transducer, b: Transducer, symbols: str = TAGS) -> Transducer:
    """The transducer that reads with ``a`` and feeds what it writes to ``b``: weights add up, only reachable pairs of states exist."""
    out = Transducer(start=(a.start, b.start))
    todo, seen = [out.start], {out.start}
    while todo:
        p, q = state = todo.pop()
        for s in symbols:
            mid, w1, p2 = a.step(p, s)
            last, w2, q2 = b.step(q, mid)
            out.arcs[(state, s)] = (last, w1 + w2, (p2, q2))
            if (p2, q2) not in seen:
                seen.add((p2, q2))
                todo.append((p2, q2))
    return out


def negation() -> Transducer:
    t = Transducer({("-", "N"): ("N", 0.0, "not")}, "-")
    for s, o in (("I", "i"), ("H", "h")):
        t.arcs[("not", s)] = (o, NEGATED, "not")
    for s in "CE":
        t.arcs[("not", s)] = (s, 0.0, "-")
    return t


def reported() -> Transducer:
    """States: plain, said (until the sentence ends), quoted (until the quote closes)."""
    t = Transducer({("-", "S"): ("S", 0.0, "said"), ("said", "Q"): ("Q", 0.0, "quoted"), ("quoted", "Q"): ("Q", 0.0, "-"), ("said", "E"): ("E", 0.0, "-")}, "-")
    for state in ("said", "quoted"):
        for s, o in zip("IHih", "JGjg"):
            t.arcs[(state, s)] = (o, REPORTED, state)
    return t


def target() -> Transducer:
    """An insult after a target is aimed; a target that follows insults adds the aim of the last of them."""
    t = Transducer(start="-")
    for s in "IiJj":
        t.arcs[("-", s)] = (s, 0.0, "hit")
        t.arcs[("hit", s)] = (s, 0.0, "hit")
        t.arcs[("you", s)] = (s, AIMED, "you")
    t.arcs[("-", "Y")] = t.arcs[("you", "Y")] = ("Y", 0.0, "you")
    t.arcs[("hit", "Y")] = ("A", AIMED, "you")
    for state in ("hit", "you"):
        t.arcs[(state, "E")] = ("E", 0.0, "-")
    return t


def threat() -> Transducer:
    """A threat without a target in its clause hardly counts; the target that follows it makes it count."""
    t = Transducer(start="-")
    for s in "HhGg":
        t.arcs[("-", s)] = (s, LOOSE_THREAT, "threat")
        t.arcs[("threat", s)] = (s, LOOSE_THREAT, "threat")
        t.arcs[("you", s)] = (s, 0.0, "you")
    for y in "YA":
        t.arcs[("-", y)] = t.arcs[("you", y)] = (y, 0.0, "you")
        t.arcs[("threat", y)] = ("T", 0.0, "you")
    for state in ("threat", "you"):
        for s in "CE":
            t.arcs[(state, s)] = (s, 0.0, "-")
    return t


def grammar() -> Transducer:
    return compose(compose(compose(negation(), reported()), target()), threat())


@dataclass(frozen=True)
class Model:
    words: dict  # term -> weight
    stems: dict
    coef: np.ndarray | None  # None: nothing was learnt


class _Lexicon(dict):
    """Token -> (symbol, weight) or None; remembers what it has looked up, within a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.words, self.stems = model.words, model.stems
        self.fixed = {**{w: ("Y", 0.0) for w in TARGETS}, **{w: ("N", 0.0) for w in NEGATIONS}, **{w: ("S", 0.0) for w in SPEECH}, **{w: ("H", THREAT_WEIGHT) for w in THREATS}}
        for marks, s in ((QUOTES, "Q"), (CLAUSE, "C"), (SENTENCE, "E")):
            self.fixed.update({m: (s, 0.0) for m in marks})

    def __missing__(self, token: str):
        best = self.words.get(token, 0.0)
        for k in STEM_SIZES:
            if k > len(token):
                break
            best = max(best, self.stems.get(token[:k], 0.0))
        got = self.fixed.get(token) if best <= 0 else ("I", best)
        if len(self) > _CACHE:
            self.clear()
        self[token] = got
        return got


def read_clauses(symbols: list, machine: Transducer) -> list[tuple[int, float, str]]:
    """Run (place, symbol, weight) through the machine: (place, matched weight, symbol written) of every match.

    A target that comes later adds to the match before it: ``A`` aims the last
    insult, ``T`` completes the last threat (and, with a weight, aims the insult too).
    """
    state, out = machine.start, []
    last = {"insult": -1, "threat": -1}
    for place, s, w in symbols:
        o, arc, state = machine.step(state, s)
        if o in _MATCHES:
            last["threat" if o in "HhGg" else "insult"] = len(out)
            out.append((place, w * np.exp(arc), o))
        elif o in ("A", "T"):
            for kind, add in (("insult", arc), ("threat", -LOOSE_THREAT if o == "T" else 0.0)):
                if add and last[kind] >= 0:
                    p, v, sym = out[last[kind]]
                    out[last[kind]] = (p, v * np.exp(add), sym)
    return out


def features(text: str, lexicon: _Lexicon, machine: Transducer) -> tuple[np.ndarray, list]:
    """Match weights of a text (all, strongest sentence, by length) and its matches (token number, weight, symbol)."""
    tokens = TOKEN.findall(text.lower())
    found = [lexicon[t] for t in tokens]
    words = len(tokens)
    row = np.array([1.0, 0.0, 0.0, 0.0, np.log1p(words)])
    if not any(f is not None and f[0] in "IH" for f in found):
        return row, []
    symbols = [(i, f[0], f[1]) for i, f in enumerate(found) if f is not None]
    matches = read_clauses(symbols, machine)
    ends = np.array([i for i, s, _ in symbols if s == "E"] or [words])
    by = Counter()
    for place, w, _ in matches:
        by[int(np.searchsorted(ends, place))] += w
    total = sum(by.values())
    row[1:4] = np.log1p(total), np.log1p(max(by.values(), default=0.0)), total / np.sqrt(1.0 + words)
    return row, matches


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method with a ridge on all but the first coefficient."""
    coef = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ coef)
        coef = coef + step
        if np.abs(step).max() < 1e-9:
            break
    return coef


def training_sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, per_label: int) -> DataFrame:
    """(text, label) of about ``per_label`` ids of each label; the drawn ids are so few that they are sent to the texts."""
    ids = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).cast("int").alias("label"))
    sizes = {r.label: r.n for r in ids.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(min(1.0, per_label / n))) for k, n in sorted(sizes.items())], F.lit(0.0))
    drawn = ids.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share)
    return docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(drawn), "id").select("text", "label")


def learn_terms(sample: DataFrame, min_docs: int, min_odds: float, max_terms: int, by_chance: float) -> tuple[dict, dict]:
    """Words and stems with their log odds; texts of one label with the same smallest shingle hash count once."""

    def sketch(batches):
        for batch in batches:
            first = [int(s[0]) & ((1 << 63) - 1) if len(s := shingle_set(t)) else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(first, pa.int64())], names=["text", "label", "sketch"])

    one_each = sample.mapInArrow(sketch, "text string, label int, sketch long").groupBy("label", "sketch").agg(F.min("text").alias("text"))

    def count(batches):
        c: list[Counter] = [Counter(), Counter()]
        n = [0, 0]

        def rows():
            keys = [*c[0], *(k for k in c[1] if k not in c[0])]
            out = pa.RecordBatch.from_arrays([pa.array([*keys, ""], pa.string()), pa.array([*(c[0][k] for k in keys), n[0]], pa.int64()), pa.array([*(c[1][k] for k in keys), n[1]], pa.int64())], names=["term", "n0", "n1"])
            for x in c:
                x.clear()
            n[:] = [0, 0]
            return out

        for batch in batches:
            for label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w for w in re.findall(r"\w+", t.lower()) if len(w) <= 40}
                n[label] += 1
                c[label].update({"=" + w for w in words} | {w[:k] for w in words for k in STEM_SIZES if k <= len(w)})
                if len(c[0]) + len(c[1]) > 400_000:
                    yield rows()
        yield rows()

    counts = one_each.select("label", "text").mapInArrow(count, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    whole = F.col("term") == ""
    counts = materialize(counts.where((F.col("n1") >= min_docs) | whole), "toxicity-terms")
    total = counts.where(whole).first()
    if total is None or not total.n0 or not total.n1:
        return {}, {}
    tested = counts.count() - 1
    share = total.n1 / (total.n0 + total.n1)
    n = F.col("n0") + F.col("n1")
    odds = F.log((F.col("n1") + 0.5) / (total.n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (total.n0 + 1.0))
    # Log of how unlikely this many texts with label 1 are by chance (Chernoff's bound); must outweigh the number of terms tested.
    evidence = F.col("n1") * F.log(F.col("n1") / n / share) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / n / (1 - share))).otherwise(0.0)
    scored = counts.where(~whole).withColumns({"odds": odds, "evidence": evidence})
    best = scored.where((F.col("odds") >= min_odds) & (F.col("evidence") >= float(np.log(max(tested, 1) / by_chance)))).orderBy(F.col("evidence").desc(), "term").limit(4 * max_terms).collect()
    bare = {r.term: r.term.lstrip("=") for r in best}
    below = Counter()  # most texts that one longer term of the same beginning explains
    for r in best:
        for k in STEM_SIZES:
            if k < len(bare[r.term]) or (k == len(bare[r.term]) and r.term != bare[r.term]):
                below[bare[r.term][:k]] = max(below[bare[r.term][:k]], r.n1)
    words, stems = {}, {}
    for r in best:  # the strongest first
        term, whole_word = bare[r.term], r.term.startswith("=")
        if len(words) + len(stems) >= max_terms or any(term[:k] in stems for k in STEM_SIZES if k <= len(term)):
            continue
        if whole_word or r.n1 > 1.1 * below[term]:
            (words if whole_word else stems)[term] = float(r.odds)
    return words, stems


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    sample_per_label: int = 6000, min_docs: int = 4, min_odds: float = 2.0, max_terms: int = 20_000, by_chance: float = 0.05,
) -> Model:
    """Learn terms and the logistic function from a bounded sample of the labelled rows."""
    ship_package(docs.sparkSession)
    sample = materialize(training_sample(docs, labels, text, doc_id, label, sample_per_label), "toxicity-sample")
    words, stems = learn_terms(sample, min_docs, min_odds, max_terms, by_chance)
    empty = Model(words, stems, None)

    def measure(batches):
        lexicon, machine = _Lexicon(empty), grammar()
        for batch in batches:
            rows = [features(t, lexicon, machine)[0].tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])

    rows = sorted((tuple(r.x), r.label) for r in sample.mapInArrow(measure, "label int, x array<double>").collect())  # at most about 2 * sample_per_label
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    if len(set(y.tolist())) < 2:
        return empty
    return Model(words, stems, fit_logistic(x, y))


_CLAUSES = "array<struct<token:int,weight:double,pattern:string>>"


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score, predicted and matches (token number, weight, pattern symbol)."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted", "matches")]
    sent = spark.sparkContext.broadcast(model)
    at = kept.index(text)
    kind = pa.list_(pa.struct([("token", pa.int32()), ("weight", pa.float64()), ("pattern", pa.string())]))

    def run(batches):
        m = sent.value
        lexicon, machine = _Lexicon(m), grammar()
        for batch in batches:
            scores, shown = [], []
            for t in batch.column(at).to_pylist():
                x, matches = features(t or "", lexicon, machine)
                scores.append(0.0 if m.coef is None else float(1 / (1 + np.exp(-np.clip(x @ m.coef, -30, 30)))))
                shown.append([{"token": i, "weight": float(w), "pattern": p} for i, w, p in matches])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(shown, kind)],
                names=[*kept, "score", "predicted", "matches"],
            )

    own = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*own.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("matches", T._parse_datatype_string(_CLAUSES))])
    return own.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """One document in five is never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Learn from the labelled documents that are not held out, and score all documents."""
    learnt = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return score(docs, fit(docs, learnt, **params))
