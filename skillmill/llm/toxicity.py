"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers read the words of a clause and are composed into one machine:

* insult emits the weight of a word of the lexicon (below) and accepts the clause;
* threat emits the weight of a threatening verb; it accepts the clause if a target stood a few words
  before the verb, or follows it before the clause ends, and only then do the emitted weights count;
* target remembers a person addressed or named a few words ago, and raises the weight;
* negation remembers a negating word a few words ago, and lowers it;
* reported speech remembers a verb of saying or an open quotation until the clause ends, and lowers it.

The score comes from the matched clauses: the heaviest, their sum and their number, through a
logistic curve.  A word alone has no score; its weight counts as its clause lets it.

The lexicon is learned: words, and word beginnings of some letters, that are many times
as frequent in documents labelled toxic, among at most ``per_class`` labelled documents of
each class.  The curve is fitted on the same documents, each fold of them read with the
lexicon of the other folds.  Every text is read whole.

Defined results: null or empty text, or one without a match, has no clause and gets the
constant of the curve; without labels of both classes every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import Memo, blocks
from skillmill.llm.labelled import logistic, probability, sample

NONE, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)

# Word lists, chosen here for English, German, French and Spanish.
# ``tue`` and ``tues`` (French: kill) are left out; German ``tue`` means do.
THREATS = frozenset(
    """kill kills killed killing murder murders murdered murdering hurt hurts hurting burn burns burned burnt burning
    töten töte tötest tötet tötete getötet umbringen umbringe umbringst umbringt umgebracht verletzen verletze verletzt verletzte
    tuer tuez tué tuée tuerai tuera tuerez tueront frapper frappe frappes frappé frapperai frappera
    matar mato mata matas matan maté mataré matará matado golpear golpeo golpea golpeas golpeé golpearé golpeará""".split()
)
TARGETS = frozenset(
    "you your you're youre he she they him her them du dich ihr euch sie tu te toi vous ils elles tú usted ustedes vosotros".split()
)
NEGATIONS = frozenset(
    "not no never isn't aren't don't doesn't wasn't nicht kein keine keinen nie ne pas jamais aucun nunca jamás ningún tampoco".split()
)
REPORTS = frozenset(
    "said says say told wrote writes called calls quoted claimed sagte sagt schrieb nannte dit disait écrit appelle dijo dice escribió llamó".split()
)

#: Words a target or a negation stays in force.
REACH = 4
FACTORS = {"target": 1.25, "negation": 0.5, "report": 0.6}
THREAT_WEIGHT = 2.0
STEM_LETTERS = range(4, 9)
FEATURES = 3
FOLDS = 4

_END = re.compile(r"[.!?;:\n]\W*$")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_DISGUISE = str.maketrans("013457@$", "oieastas")


class Transducer:
    """States, a step (state, symbol) -> (state, factor), and the symbols whose weights a last state lets count."""

    def __init__(self, states: int, step, accepts=lambda state: ()):
        self.states, self.step, self.accepts = states, step, accepts


def insult() -> Transducer:
    """Accepts a clause with a word of the lexicon."""

    def step(state: int, read: int) -> tuple[int, float]:
        return (1 if read == INSULT else state), 1.0

    return Transducer(2, step, lambda state: (INSULT,) if state else ())


def threat() -> Transducer:
    """Emits the weight of threats and accepts a clause that has their target too.

    Until a threat, the state is for how many words a target stays in force; then whether there is one.
    """
    waiting, settled = REACH + 1, REACH + 2

    def step(state: int, read: int) -> tuple[int, float]:
        factor = THREAT_WEIGHT if read == THREAT else 1.0
        if state >= waiting:
            return (settled if read == TARGET else state), factor
        if read == THREAT:
            return (settled if state else waiting), factor
        return (REACH if read == TARGET else max(0, state - 1)), factor

    return Transducer(REACH + 3, step, lambda state: (THREAT,) if state == settled else ())


def reach(symbol: int, factor: float) -> Transducer:
    """In force for some words after ``symbol``."""

    def step(state: int, read: int) -> tuple[int, float]:
        return (REACH if read == symbol else max(0, state - 1)), (factor if state else 1.0)

    return Transducer(REACH + 1, step)


def reported() -> Transducer:
    """In force from a verb of saying, or inside quotation marks, to the clause's end."""

    def step(state: int, read: int) -> tuple[int, float]:
        after = 1 if read == REPORT else (0 if state == 2 else 2) if read == QUOTE else state
        return after, (FACTORS["report"] if state else 1.0)

    return Transducer(3, step)


def compose(*parts: Transducer) -> tuple[np.ndarray, np.ndarray, list[tuple[int, ...]]]:
    """The product machine, begun in state 0: next state and factor by (state, symbol), symbols that count by last state."""
    sizes = [p.states for p in parts]
    total = int(np.prod(sizes))
    after, factor, accepted = np.zeros((total, 7), dtype=np.int64), np.ones((total, 7)), []
    for state in range(total):
        held = np.unravel_index(state, sizes)
        accepted.append(tuple(x for p, s in zip(parts, held, strict=True) for x in p.accepts(int(s))))
        for symbol in range(7):
            steps = [p.step(int(s), symbol) for p, s in zip(parts, held, strict=True)]
            after[state, symbol] = np.ravel_multi_index([s for s, _ in steps], sizes)
            factor[state, symbol] = np.prod([f for _, f in steps])
    return after, factor, accepted


START = 0
_AFTER, _FACTOR, ACCEPTED = compose(
    insult(), threat(), reach(TARGET, FACTORS["target"]), reach(NEGATION, FACTORS["negation"]), reported()
)
AFTER, FACTOR = _AFTER.tolist(), _FACTOR.tolist()


def words_of(text: str | None) -> list[str]:
    """The words of a text, as ``split`` has them, and its line feeds."""
    lines = (text or "").split("\n")
    found = lines[0].split()
    for line in lines[1:]:
        found.append("\n")
        found += line.split()
    return found


def plain_word(token: str) -> str:
    """Lower case, without marks at the ends, digits and signs inside read as the letters they stand for."""
    word = _EDGE.sub("", token.lower())
    if word and not word.isalpha() and word[0].isalpha() and any(c in word for c in "013457@$"):
        letters = sum(c.isalpha() for c in word)
        if letters * 2 >= len(word):
            return word.translate(_DISGUISE)
    return word


def parts(word: str) -> list[str]:
    """The word, and its beginnings marked with a hyphen."""
    return [word, *[word[:k] + "-" for k in STEM_LETTERS if k < len(word)]]


class Grammar:
    """Reads texts with a lexicon of word and stem weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.memo = Memo(lambda tokens: [self.read(t) for t in tokens])

    def read(self, token: str) -> tuple[int, float, bool, bool] | tuple:
        """(symbol, weight, a quotation mark precedes or follows, ends a clause); empty if nothing of it counts."""
        word = plain_word(token)
        weight = max((self.lexicon.get(p, 0.0) for p in parts(word)), default=0.0) if len(word) > 1 else 0.0
        symbol = (
            INSULT if weight else THREAT if word in THREATS else TARGET if word in TARGETS
            else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else NONE
        )
        quotes = token[:1] in "\"“«„" or token[-1:] in "\"”»"
        end = bool(_END.search(token))
        return (symbol, weight, quotes, end) if symbol or quotes or end else ()

    def clauses(self, text: str | None) -> list[float]:
        """The weights of the clauses that hold an insult, or a threat against a target."""
        found = []
        state, insults, threats = START, 0.0, 0.0

        def settle() -> None:
            counted = ACCEPTED[state]
            if counted:
                found.append((insults if INSULT in counted else 0.0) + (threats if THREAT in counted else 0.0))

        for item in self.memo.all(words_of(text)):
            if not item:
                if state != START:
                    state = AFTER[state][NONE]
                continue
            symbol, own, quotes, end = item
            if symbol == INSULT:
                insults += own * FACTOR[state][symbol]
            elif symbol == THREAT:
                threats += FACTOR[state][symbol]
            state = AFTER[state][symbol]
            if quotes:
                state = AFTER[state][QUOTE]
            if end:
                settle()
                state, insults, threats = START, 0.0, 0.0
        settle()
        return found

    def features(self, text: str | None) -> list[float]:
        weights = self.clauses(text)
        return [max(weights, default=0.0), float(np.log1p(sum(weights))), float(np.log1p(len(weights)))]


def learn_lexicon(rows: Iterable[tuple[int, str]], least: int = 3, factor: float = 12.0, most: int = 5_000) -> dict[str, float]:
    """Weights of words and stems at least ``factor`` times as frequent in toxic documents."""
    counts, size = (Counter(), Counter()), [0, 0]
    for label, text in rows:
        size[label] += 1
        words = {plain_word(t) for t in set(words_of(text))}
        counts[label].update({p for w in words if len(w) > 2 for p in parts(w)})
    lexicon = {}
    for part, toxic in counts[1].items():
        if toxic < least:
            continue
        clean = counts[0][part]
        ratio = (toxic + 0.5) / (size[1] + 1) / ((clean + 0.5) / (size[0] + 1))
        if ratio >= factor and clean * 10 <= toxic:
            lexicon[part] = float(np.log(ratio))
    return dict(sorted(lexicon.items(), key=lambda x: (-x[1], x[0]))[:most])


def fit(rows: list[tuple[int, str]], share: float) -> dict:
    """Lexicon and curve.  ``share`` of all labelled documents are toxic."""
    by = {k: [r for r in rows if r[0] == k] for k in (0, 1)}
    if not by[0] or not by[1] or not 0 < share < 1:
        return {"lexicon": {}, "weights": np.array([0.0] * FEATURES + [-30.0])}
    folds = [[*by[0][k::FOLDS], *by[1][k::FOLDS]] for k in range(FOLDS)]
    features, label = [], []
    for k, own in enumerate(folds):
        grammar = Grammar(learn_lexicon(r for i, fold_ in enumerate(folds) if i != k for r in fold_))
        features += [grammar.features(t) for _, t in own]
        label += [y for y, _ in own]
    weights = logistic(np.array(features).reshape(-1, FEATURES), np.array(label))
    weights[-1] += np.log(share / (1 - share))
    return {"lexicon": learn_lexicon(rows), "weights": weights}


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of ``docs`` (doc_id, text)."""

    def run(batches):
        grammar = Grammar(model["lexicon"])
        for block in blocks(batches):
            x = np.array([grammar.features(t) for t in block["text"]]).reshape(-1, FEATURES)
            score = probability(model["weights"], x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["doc_id"], pa.int64()), pa.array(score, pa.float64())], ["doc_id", "score"]
            )

    return docs.mapInArrow(run, "doc_id long, score double")


def fitted(docs: DataFrame, labels: DataFrame, train: Column, per_class: int = 4_000) -> dict:
    chosen, share = sample(docs, labels, "toxic", train, per_class)
    rows = [(r.label, r.text) for r in chosen.select("label", "text").collect()]
    return fit(sorted(rows), share)


def toxicity(docs: DataFrame, labels: DataFrame, train: Column, per_class: int = 4_000, cut: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row; a higher score makes label 1 likelier."""
    model = fitted(docs, labels, train, per_class)
    found = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), model)
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def reject_toxic(docs: DataFrame, labels: DataFrame, train: Column, per_class: int = 4_000, cut: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose text scores ``cut`` or more."""
    model = fitted(docs, labels, train, per_class)
    names = docs.columns

    def run(batches):
        grammar = Grammar(model["lexicon"])
        for batch in batches:
            x = np.array([grammar.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, FEATURES)
            yield batch.filter(pa.array(probability(model["weights"], x) < cut, pa.bool_()))

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, docs.schema)
