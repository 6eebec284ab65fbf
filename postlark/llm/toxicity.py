"""Toxicity by a learned lexicon, found again through misspellings, with the words around it."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlark.session import stage

SAMPLE_DOCUMENTS = 20_000  # labelled documents at most that lexicon and weights are learned from
CALIBRATION_PART = 3  # one in so many of them fits the weights, the others the lexicon
MIN_DOCUMENTS = 3  # toxic documents that a term needs, and one in RARE of them
RARE = 250
COPY_WORDS = 5  # labelled documents that share the least hash of their runs of so many words are taken for copies
TERM_ODDS = 2.5  # least log-odds of a term
STRONG_ODDS = 4.0  # of a term that is counted besides
EXCEPTION_ODDS = 1.0  # a longer term within it that has less is an exception
SHORTEST_TERM, LONGEST_PREFIX, LONGEST_WORD = 3, 16, 40
ONE_EDIT_FROM, TWO_EDITS_FROM = 4, 9  # letters of a term
FUZZY_SHARE, FUZZY_PRIOR = 0.6, 5  # a misspelt term's weight before any was seen, and how many documents that counts for
MOST_WEIGHT, MOST_EVIDENCE = 5.0, 40.0
CONTEXT = 60  # characters on either side
REMEMBERED = 200_000
WORD = re.compile(r"[^\W_]+(?:[*@$!|]+[^\W_]+)*")
# Words that report what others said, and words that address the reader, in four languages.
REPORTING = re.compile(
    r"\b(said|says|called|calling|quote|quoted|wrote|word|words|term|insult|insults|slur|sagte|sagt|nannte|wort|zitat|dit|écrit|"
    r"appelé|mot|citation|dijo|dice|llamó|palabra|cita)\b")
ADDRESS = re.compile(r"\b(you|your|youre|u|ur|du|dich|dein|ihr|euch|tu|toi|ton|vous|votre|tú|te|usted|eres|vosotros)\b")
OPENING, CLOSING = "“«„‹", "”»“›"
QUOTED_SHARE = 0.2  # of a quoted term's weight that counts as evidence
FEATURES = ("one", "evidence", "fuzzy", "quoted", "strong", "directed", "length")
PRIOR = (-3.0, 0.5, 0.0, 0.0, 1.0, 0.5, 0.0)  # weights before any document was seen
PRECISION = (0.01, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
HIT = "start int, word string, term string, edits int, quoted boolean"


@dataclass
class Term:
    text: str
    whole: bool  # the whole word, or any word that begins so
    weight: float
    fuzzy: float = 0.0

    @property
    def edits(self) -> int:
        return (len(self.text) >= ONE_EDIT_FROM) + (len(self.text) >= TWO_EDITS_FROM) if self.weight >= TERM_ODDS else 0


@dataclass
class Lexicon:
    """The terms as a trie, and its intersection with the Levenshtein automaton of each of them.

    A state of the intersection is the set of (node, edits spent, swapped letter awaited) that the letters read so far can
    have led to. States are made when they are first needed and remembered, so a word costs a step for each of its letters,
    and most words are lost after a few.
    """

    terms: list[Term]
    every: bool = False  # also what weighs nothing is found
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    words: dict[int, int] = field(default_factory=dict)
    prefixes: dict[int, int] = field(default_factory=dict)
    budget: dict[int, int] = field(default_factory=lambda: defaultdict(int))

    def __post_init__(self) -> None:
        for i, term in enumerate(self.terms):
            node = 0
            self.budget[0] = max(self.budget[0], term.edits)
            for letter in term.text:
                if letter not in self.children[node]:
                    self.children.append({})
                    self.children[node][letter] = len(self.children) - 1
                node = self.children[node][letter]
                self.budget[node] = max(self.budget[node], term.edits)
            (self.words if term.whole else self.prefixes)[node] = i
        self._forget()
        self.met: dict[str, tuple[int, int] | None] = {}

    def _forget(self) -> None:
        self.states: list[frozenset] = []
        self.ends: list[tuple[tuple[int, float, int], tuple[int, float, int]]] = []  # the best term begun with, and whole
        self.number: dict[frozenset, int] = {}
        self.steps: dict[tuple[int, str], int] = {}
        self.start = self._state({(0, 0, "")})

    def _state(self, items: set) -> int:
        """The number of the state of these items and of those that leaving out letters of terms leads to."""
        least: dict[tuple[int, str], int] = {}
        todo = list(items)
        while todo:
            node, spent, awaited = todo.pop()
            if spent <= self.budget[node] and spent < least.get((node, awaited), 99):
                least[node, awaited] = spent
                if not awaited:
                    todo += [(child, spent + 1, "") for child in self.children[node].values()]
        state = frozenset((node, spent, awaited) for (node, awaited), spent in least.items())
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.ends.append((self._best(state, self.prefixes), self._best(state, self.words)))
        return self.number[state]

    def _step(self, state: int, letter: str) -> int:
        after = set()
        for node, spent, awaited in self.states[state]:
            if awaited:
                if letter == awaited:
                    after.add((node, spent, ""))
                continue
            after.add((node, spent + 1, ""))  # a letter too many
            for other, child in self.children[node].items():
                after.add((child, spent + (other != letter), ""))
                if other != letter and letter in self.children[child]:
                    after.add((self.children[child][letter], spent + 1, other))  # two letters swapped
        return self._state(after)

    def exact(self, word: str) -> int:
        """The longest term that the word is or begins with, -1 if there is none."""
        node, found = 0, -1
        for letter in word:
            node = self.children[node].get(letter, -1)
            if node < 0:
                return found
            found = self.prefixes.get(node, found)
        return self.words.get(node, found)

    def _best(self, state: frozenset, table: dict[int, int]) -> tuple[int, float, int]:
        """(edits, -weight, term) of the best term that the state accepts."""
        best = (9, 0.0, -1)
        for node, spent, awaited in state:
            term = table.get(node, -1)
            if not awaited and term >= 0 and spent <= self.terms[term].edits:
                best = min(best, (spent, -self.terms[term].weight, term))
        return best

    def misspelt(self, word: str) -> tuple[int, int] | None:
        """The term that the word, or its beginning, is within the term's edits of, fewest edits first; and the edits."""
        if len(self.steps) > REMEMBERED:
            self._forget()
        state, best, steps, ends = self.start, (9, 0.0, -1), self.steps, self.ends
        for letter in word:
            after = steps.get((state, letter))
            if after is None:
                after = steps[state, letter] = self._step(state, letter)
            state = after
            if not self.states[state]:
                break
            if ends[state][0] < best:
                best = ends[state][0]
        best = min(best, ends[state][1])
        return (best[2], best[0]) if best[2] >= 0 else None

    def find(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of a word, if they weigh anything; remembered for the words last met."""
        if word not in self.met:
            if len(self.met) > REMEMBERED:
                self.met.clear()
            term = self.exact(word)
            hit = (term, 0) if term >= 0 else self.misspelt(word)
            if hit and not self.every and not (self.terms[hit[0]].fuzzy if hit[1] else self.terms[hit[0]].weight):
                hit = None
            self.met[word] = hit
        return self.met[word]


_LAST: list[Lexicon] = []


def lexicon_of(terms: list[Term]) -> Lexicon:
    """The lexicon of the terms, kept for the worker's next task."""
    if not _LAST or _LAST[0].terms != terms:
        _LAST[:] = [Lexicon(terms)]
    return _LAST[0]


@dataclass
class Model:
    terms: list[Term]
    weights: list[float]


def _quoted(line: str, start: int, end: int) -> bool:
    """Whether the quotation marks around say that the words are someone else's."""
    before, after = line[:start], line[end:]
    if before.count('"') % 2 and '"' in after:
        return True
    opened = max(before.rfind(mark) for mark in OPENING)
    closed = max(before.rfind(mark) for mark in CLOSING if mark not in OPENING)
    return opened > closed and any(mark in after for mark in CLOSING)


def evidence(text: str | None, lexicon: Lexicon) -> tuple[list[float], list[dict]]:
    """The features of a text, and the words found: where each first stands, its term, its edits and whether it is quoted
    or reported everywhere."""
    lower = (text or "").lower()
    words = WORD.findall(lower)
    found = {word: hit for word in set(words) if (hit := lexicon.find(word))}
    hits: dict[str, dict] = {}
    directed = 0
    for match in WORD.finditer(lower) if found else ():
        word = match.group()
        if word not in found:
            continue
        term, edits = found[word]
        low, high = max(0, match.start() - CONTEXT), match.end() + CONTEXT
        before, after = lower[low:match.start()].rpartition("\n")[2], lower[match.end():high].partition("\n")[0]
        around = f"{before} {after}"
        quoted = _quoted(f"{before}{word}{after}", len(before), len(before) + len(word)) or bool(REPORTING.search(around))
        directed += bool(not quoted and lexicon.terms[term].weight > 0 and ADDRESS.search(around))
        if word in hits:
            hits[word]["quoted"] &= quoted
        else:
            hits[word] = {"start": match.start(), "word": word, "term": lexicon.terms[term].text, "edits": edits, "quoted": quoted}
    sums = Counter()
    for word, hit in hits.items():
        term = lexicon.terms[found[word][0]]
        sums["quoted" if hit["quoted"] else "fuzzy" if hit["edits"] else "exact"] += term.fuzzy if hit["edits"] else term.weight
        sums["strong"] += not hit["quoted"] and not hit["edits"] and term.weight >= STRONG_ODDS
    whole = sums["exact"] + sums["fuzzy"] + QUOTED_SHARE * sums["quoted"]
    capped = [min(MOST_EVIDENCE, x) for x in (whole, sums["fuzzy"], sums["quoted"])]
    return [1.0, *capped, math.log1p(sums["strong"]), math.log1p(directed), math.log1p(len(words))], list(hits.values())


def _odds(toxic: float, clean: float, toxics: int, cleans: int) -> float:
    raw = math.log((toxic + 0.5) / (toxics + 1)) - math.log((clean + 0.5) / (cleans + 1))
    return max(-MOST_WEIGHT, min(MOST_WEIGHT, raw))


def choose_terms(counts: dict[tuple[str, bool], tuple[int, int]], toxics: int, cleans: int) -> list[Term]:
    """The terms of counts (toxic and clean documents) by (text, whole word).

    Common in toxic documents against clean ones, and not merely the beginning of one longer term that has nearly all of
    its documents.
    """
    least = max(MIN_DOCUMENTS, toxics / RARE)
    longer: dict[str, int] = defaultdict(int)
    for (text, whole), (toxic, _) in counts.items():
        inner = text if whole else text[:-1]
        longer[inner] = max(longer[inner], toxic)
    odds = {key: _odds(*n, toxics, cleans) for key, n in counts.items()}
    chosen = {
        (text, whole) for (text, whole), (toxic, _) in counts.items()
        if toxic >= least and odds[text, whole] >= TERM_ODDS and (whole or longer[text] < 0.9 * toxic)}
    return [Term(text, whole, odds[text, whole]) for text, whole in sorted(chosen)]


def exceptions(terms: list[Term], counts: dict[tuple[str, bool], tuple[int, int]], toxics: int, cleans: int) -> list[Term]:
    """Longer keys within a term that lack its odds. They weigh nothing, and since the longest match decides, nor do words
    that they match."""
    chosen = {(t.text, t.whole) for t in terms}
    prefixes = {t.text for t in terms if not t.whole}
    return [
        Term(text, whole, 0.0) for (text, whole), n in sorted(counts.items())
        if (text, whole) not in chosen and sum(n) >= MIN_DOCUMENTS and _odds(*n, toxics, cleans) < EXCEPTION_ODDS
        and any(text[:k] in prefixes for k in range(SHORTEST_TERM, len(text) + whole))]


def _by_key(rows: DataFrame) -> dict[tuple[str, bool], tuple[int, int]]:
    return {(r.text, r.whole): (r.toxic, r.clean) for r in rows.collect()}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents each word and beginning of a word stands, a task's share."""
    counts: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = set(WORD.findall((text or "").lower()))
            keys = {(w, True) for w in words if SHORTEST_TERM <= len(w) <= LONGEST_WORD}
            keys |= {(w[:k], False) for w in words for k in range(SHORTEST_TERM, min(len(w), LONGEST_PREFIX) + 1)}
            for key in keys:
                counts[key][1 - label] += 1
    keys, values = list(counts), list(counts.values())
    for i in range(0, len(keys), 50_000):
        part, n = keys[i:i + 50_000], values[i:i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in part]), pa.array([k[1] for k in part]), pa.array([x[0] for x in n], pa.int64()),
             pa.array([x[1] for x in n], pa.int64())], names=["text", "whole", "toxic", "clean"])


def _misspelt(terms: list[Term]):
    """How many toxic and clean documents have each misspelt word, with its term."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, every=True)
        counts: dict[tuple[int, str], list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                for word in set(WORD.findall((text or "").lower())):
                    hit = lexicon.find(word)
                    if hit and hit[1]:
                        counts[hit[0], word][1 - label] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.int64()), pa.array([k[1] for k in counts], pa.string()),
             pa.array([n[0] for n in counts.values()], pa.int64()), pa.array([n[1] for n in counts.values()], pa.int64())],
            names=["term", "word", "toxic", "clean"])

    return task


def _featured(terms: list[Term]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of(terms)
        for batch in batches:
            found = [evidence(text, lexicon)[0] for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.float64()))], names=["label", "features"])

    return task


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights, drawn towards PRIOR where the rows say little, by Newton's method."""
    prior, precision = np.array(PRIOR), np.array(PRECISION)
    weights = prior.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (precision * (w - prior) ** 2).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
        slope = x.T @ (p - y) + precision * (weights - prior)
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(precision), slope)
        size = 1.0
        while size > 1e-6 and loss(weights - size * move) > loss(weights):
            size /= 2
        weights = weights - size * move
        if np.abs(size * move).max() < 1e-9:
            break
    return weights


def _least_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two least hashes of each text's runs of words, which copies mostly share."""
    for batch in batches:
        found: list[tuple[int, int]] = []
        for text in batch.column("text").to_pylist():
            words = (text or "").split()
            runs = {zlib.crc32(" ".join(words[i:i + COPY_WORDS]).encode()) for i in range(max(1, len(words) - COPY_WORDS + 1))}
            found.append((min(runs), min(x * 2654435761 % 2**32 for x in runs)))
        for name, values in zip(("one", "two"), zip(*found, strict=True) if found else ((), ()), strict=True):
            batch = batch.append_column(name, pa.array(values, pa.int64()))
        yield batch


def sample(docs: DataFrame, labels: DataFrame, learn: Column, key: str, text: str, label: str, most: int) -> DataFrame:
    """(text, label, part) of at most ``most`` labelled documents, those whose keys have the smallest hashes.

    A key is taken once, and of documents that are copies of each other, exact or nearly, mostly one: else the words of a
    toxic text that was copied often would all look toxic.
    """
    order = F.xxhash64(F.lit(11), key)
    marked = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & learn).groupBy(key).agg(
        F.max((F.col(label) > 0).cast("int")).alias("label"))
    chosen = marked.select(F.col(key).alias("_id"), "label", order.alias("_order")).orderBy("_order", "_id").limit(most)
    met = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "_id")  # most rows
    part = F.pmod(F.shiftright("_order", 7), F.lit(CALIBRATION_PART)).cast("int")
    hashed = met.select("_id", "text", "label", part.alias("part")).mapInArrow(
        _least_hashes, f"_id {met.schema['_id'].dataType.simpleString()}, text string, label int, part int, one long, two long")
    for group in ("_id", "one", "two"):
        first = W.partitionBy(group).orderBy(F.desc("label"), F.xxhash64("text"), "_id")
        hashed = hashed.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
    return stage(hashed.select("text", "label", "part"), "labelled")


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text",
        label: str = "toxic", most: int = SAMPLE_DOCUMENTS) -> Model:
    """Lexicon and weights from at most ``most`` labelled documents.

    Two in three of them give the lexicon: words, and beginnings of words, that are common in toxic documents against clean
    ones, then how far misspelt ones can be trusted. The rest fits the weights of the evidence. ``learn`` says, on the rows of
    ``labels``, which may be learned from. Null keys and labels are left out, a key labelled several times is toxic if it is
    so once, of documents that share a key one is taken. Without toxic or without clean documents the lexicon is empty.
    """
    rows = sample(docs, labels, F.lit(True) if learn is None else learn, key, text, label, most)
    for_terms = rows.filter("part > 0").select("text", "label")
    sizes = {r.label: r.n for r in for_terms.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxics, cleans = sizes.get(1, 0), sizes.get(0, 0)
    terms: list[Term] = []
    if toxics and cleans:
        counted = for_terms.mapInArrow(_counted, "text string, whole boolean, toxic long, clean long").groupBy("text", "whole").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        counted = stage(counted.filter(F.col("toxic") + F.col("clean") >= MIN_DOCUMENTS), "term_counts")
        share = (F.col("toxic") + 0.5) / (toxics + 1) / ((F.col("clean") + 0.5) / (cleans + 1))
        likely = counted.filter((F.col("toxic") >= MIN_DOCUMENTS * 0.9) & (share >= math.exp(TERM_ODDS) * 0.8))  # bounded by the sample
        chosen = choose_terms(_by_key(likely), toxics, cleans)
        stems = sorted({t.text[:SHORTEST_TERM] for t in chosen if not t.whole})
        within = counted.filter(F.substring("text", 1, SHORTEST_TERM).isin(stems)) if stems else counted.limit(0)
        terms = chosen + exceptions(chosen, _by_key(within), toxics, cleans)
        terms = _weigh_misspelt(for_terms, terms, toxics, cleans)
    shown = rows.filter("part = 0").select("text", "label").mapInArrow(_featured(terms), "label int, features array<double>").collect()
    x = np.array([r.features for r in shown]).reshape(-1, len(FEATURES))
    return Model(terms, fit_weights(x, np.array([r.label for r in shown], float)).tolist())


def _weigh_misspelt(rows: DataFrame, terms: list[Term], toxics: int, cleans: int) -> list[Term]:
    """The terms with the weight of their misspellings, and misspellings seen often enough as terms of their own."""
    seen = rows.mapInArrow(_misspelt(terms), "term long, word string, toxic long, clean long").groupBy("term", "word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()  # bounded by the sample
    by_term: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    own = []
    for r in seen:
        by_term[r.term][0] += r.toxic
        by_term[r.term][1] += r.clean
        if r.toxic + r.clean >= MIN_DOCUMENTS:
            odds = _odds(r.toxic, r.clean, toxics, cleans)
            own.append(Term(r.word, True, min(odds, terms[r.term].weight) if odds >= TERM_ODDS else 0.0))
    for i, term in enumerate(terms):
        toxic, clean = by_term[i]
        prior = FUZZY_SHARE * term.weight
        learned = ((toxic + clean) * _odds(toxic, clean, toxics, cleans) + FUZZY_PRIOR * prior) / (toxic + clean + FUZZY_PRIOR)
        term.fuzzy = max(0.0, min(learned, term.weight))
    known = {(t.text, t.whole) for t in terms}
    return terms + [t for t in own if (t.text, True) not in known]


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns in ``keep`` of every document with ``score`` (0 to 1), ``predicted`` (1 from 0.5) and ``hits``: the
    distinct words found, in the order of the text, with the place of the first (code points of the lower-cased text, from
    0), the term, the edits between them and whether all of them stand in quotation or report.

    Whole texts are read, however long. Null and empty texts have no hits and the score of a text without evidence. Equal
    texts have equal scores, repeated rows stay. Columns of ``keep`` called like a result are replaced by it, other columns
    are ignored; no rows give no rows.
    """
    weights = np.array(model.weights)
    names = [c for c in keep if c.lower() not in {"score", "predicted", "hits"}]
    rows = docs.select(F.struct(*names).alias("_row"), F.col(text).cast("string").alias("_text"))
    terms = model.terms

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of(terms)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("word", pa.string()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_())]))
        for batch in batches:
            if batch.num_rows:
                found = [evidence(t.as_py(), lexicon) for t in batch.column("_text")]
                likely = 1 / (1 + np.exp(-np.clip(np.array([x for x, _ in found]) @ weights, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row"), pa.array(likely), pa.array((likely >= 0.5).astype(np.int32)), pa.array([h for _, h in found], kind)],
                    names=["_row", "score", "predicted", "hits"])

    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, score double, predicted int, hits array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>"
    return rows.mapInArrow(task, schema).select("_row.*", "score", "predicted", "hits")
