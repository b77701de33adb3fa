"""Quality rules and line labels by a linear-chain conditional random field.

Every line of a document is described by a fixed set of binary features. The labels known are of documents,
not of lines, and good documents hold boilerplate as bad ones hold sentences. So line labels are estimated first:
expectation-maximisation over kinds of lines, in which the quality of a document is no more than the share of content
that its lines have before they are looked at. A linear-chain CRF with the two labels content and boilerplate is then
trained on these lines, which also tells it how often a label changes from one line to the next. Viterbi decoding labels the lines of
every document, and the share of its words' bytes in content lines decides whether it is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import settled, ship_package
from stratalith.llm.encoding import forget

# Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_SYMBOL, _DIGIT, _ENDS = re.compile(f"[{SYMBOLS}]"), re.compile(r"\d"), frozenset(".!?:;")
# Labelled documents that the field is trained on, at most; those with the smallest hash of id are taken.
TRAIN_DOCS = 3000
# Lines of all training documents together, at most; documents that do not fit are left out whole.
TRAIN_LINES = 450_000
# A document is kept if at least this share of its words' bytes is in content lines.
LEAST_CONTENT = 0.5
CONTENT, BOILERPLATE = 0, 1
# Between what bounds the share of content lines lies in documents of known quality: most lines of a good document are content, of a
# bad one are not, and neither has lines of one label only.
BAD_SHARES, GOOD_SHARES = (0.2, 0.5), (0.75, 0.95)
_FEATURES = (
    ["words=0", "words<3", "words<6", "words<13", "words<31", "words>30"]
    + ["symbols=0", "symbols<2%", "symbols<8%", "symbols>8%"]
    + ["distinct<40%", "distinct<70%", "distinct<90%", "distinct>90%"]
    + ["length<3", "length<5", "length<7", "length>7"]
    + ["short<8%", "short<25%", "short>25%"]
    + ["capital", "ends a sentence", "repeats a line", "digits", "first", "last", "always", "shouts"]
)
N_FEATURES = len(_FEATURES)


class Base(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    if len(number) < 1 << 21:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        # Pairs are numbered first, so that keys of any vocabulary fit.
        _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        keys = pairs[:-1] * len(number) + ids[2:]
    _, index, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = count[index] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + n] |= again
    return int(inside.sum())


def base_counts(text: str) -> Base:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return Base(len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


def _step(value: float, *limits: float) -> int:
    return next((k for k, limit in enumerate(limits) if value < limit), len(limits))


def line_features(text: str) -> tuple[list[int], list[int]]:
    """For each line its features as a bit set, and the bytes of its words."""
    lines = text.split("\n")
    seen: set[str] = set()
    bits, sizes = [], []
    last = len(lines) - 1
    marked = _SYMBOL.search(text) is not None
    for k, line in enumerate(lines):
        words = line.encode().split()
        n = len(words)
        lengths = list(map(len, words))
        size = sum(lengths)
        symbols = len(_SYMBOL.findall(line)) if marked else 0
        stripped = line.strip(SPACES)
        feature = 1 << _step(n, 1, 3, 6, 13, 31)
        feature |= 1 << (6 + (_step(symbols / size, 0.02, 0.08) + 1 if symbols else 0))
        feature |= 1 << (10 + _step(len(set(words)) / n if n else 1, 0.4, 0.7, 0.9))
        feature |= 1 << (14 + _step(size / n if n else 0, 3, 5, 7))
        feature |= 1 << (18 + _step(sum([x <= 3 for x in lengths]) / n if n else 0, 0.08, 0.25))
        feature |= (stripped[:1].isupper() << 21) | ((stripped[-1:] in _ENDS) << 22) | ((n > 0 and line in seen) << 23)
        feature |= ((_DIGIT.search(line) is not None) << 24) | ((k == 0) << 25) | ((k == last) << 26) | (1 << 27)
        feature |= (n > 1 and line.isupper()) << 28
        seen.add(line)
        bits.append(feature)
        sizes.append(size)
    return bits, sizes


def matrix(bits: np.ndarray) -> np.ndarray:
    """Bit sets as rows of zeros and ones."""
    return ((np.asarray(bits, np.int64)[..., None] >> np.arange(N_FEATURES)) & 1).astype(np.float64)


class Field:
    """A two-label linear-chain CRF. ``weights``: features x labels; ``moves``: label to label."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((N_FEATURES, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves
        self.known: dict[int, tuple[float, float]] = {}

    def score(self, bits: int) -> tuple[float, float]:
        """The scores of a line as content and as boilerplate; lines with the same features are many."""
        if bits not in self.known:
            self.known[bits] = tuple((matrix(np.array([bits])) @ self.weights)[0].tolist())
        return self.known[bits]

    def viterbi(self, bits: list[int]) -> list[int]:
        """The likeliest labels of the lines; of equally likely ones, content is taken."""
        scores = list(map(self.score, bits))
        (cc, cb), (bc, bb) = self.moves.tolist()
        content, boiler = scores[0]
        back: list[tuple[int, int]] = []
        for s_content, s_boiler in scores[1:]:
            to_content = (content + cc, boiler + bc)
            to_boiler = (content + cb, boiler + bb)
            back.append((int(to_content[1] > to_content[0]), int(to_boiler[1] > to_boiler[0])))
            content, boiler = max(to_content) + s_content, max(to_boiler) + s_boiler
        label = int(boiler > content)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    @staticmethod
    def trained(documents: list[tuple[list[int], list[int]]], rounds: int = 100, rate: float = 0.1, ridge: float = 1e-3) -> Field:
        """Maximum likelihood with a ridge, by gradient steps with adaptive rates (Adam).

        ``documents``: the features and the label of each line. The sequences go through the forward and
        backward recursions side by side, the longest first: line ``t`` of all that have one lies from
        ``at[t]`` to ``at[t + 1]``, so nothing is padded.
        """
        documents = sorted((d for d in documents if d[0]), key=lambda d: -len(d[0]))
        if not documents:
            return Field()
        n, lengths = len(documents), np.array([len(b) for b, _ in documents])
        longest = int(lengths[0])
        alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
        at = np.concatenate([[0], np.cumsum(alive)])
        bits, whose, label = (np.zeros(at[-1], np.int64) for _ in range(3))
        for k, (b, y) in enumerate(documents):
            here = at[: len(b)] + k
            bits[here], whose[here], label[here] = b, k, y
        # Documents that are mostly of either label weigh alike, each line of a document the same.
        mostly = np.bincount(whose, label, n) > 0.5 * lengths
        share = np.where(mostly, 0.5 / max(1, mostly.sum()), 0.5 / max(1, (~mostly).sum())) / lengths
        # Lines with the same features are multiplied once.
        kinds, kind = np.unique(bits, return_inverse=True)
        features = matrix(kinds)
        # Each line but the first ones, and the line before it.
        later = np.arange(n, at[-1])
        before = later - np.repeat(alive[:-1], alive[1:])
        ends = at[lengths - 1] + np.arange(n)
        truth = np.zeros((len(bits), 2))
        truth[np.arange(len(bits)), label] = share[whose]
        field, state = Field(), [np.zeros((N_FEATURES + 2, 2)) for _ in range(2)]
        for step in range(1, rounds + 1):
            score = (features @ field.weights)[kind]
            forward, backward = np.zeros_like(score), np.zeros_like(score)
            forward[:n] = score[:n]
            for t in range(1, longest):
                last = forward[at[t - 1] : at[t - 1] + alive[t]]
                forward[at[t] : at[t + 1]] = np.logaddexp(last[:, :1] + field.moves[0], last[:, 1:] + field.moves[1]) + score[at[t] : at[t + 1]]
            for t in range(longest - 2, -1, -1):
                after = score[at[t + 1] : at[t + 2]] + backward[at[t + 1] : at[t + 2]]
                backward[at[t] : at[t] + alive[t + 1]] = np.logaddexp(field.moves[:, 0] + after[:, :1], field.moves[:, 1] + after[:, 1:])
            total = np.logaddexp.reduce(forward[ends], axis=1)[whose]
            belief = np.exp(forward + backward - total[:, None]) * share[whose, None]
            per_kind = np.stack([np.bincount(kind, (truth - belief)[:, y], len(kinds)) for y in range(2)], axis=1)
            gradient = features.T @ per_kind
            pair = forward[before][:, :, None] + field.moves + (score + backward)[later][:, None, :] - total[later, None, None]
            expected = (np.exp(pair) * share[whose[later], None, None]).sum(axis=0)
            moved = np.zeros((2, 2))
            np.add.at(moved, (label[before], label[later]), share[whose[later]])
            slope = np.concatenate([gradient, moved - expected]) - ridge * np.concatenate([field.weights, field.moves])
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.999 * state[1] + 0.001 * slope**2
            change = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
            field.weights, field.moves = field.weights + change[:-2], field.moves + change[-2:]
        return field


def line_labels(documents: list[tuple[list[int], bool]], rounds: int = 25, ridge: float = 1e-3) -> list[list[int]]:
    """A label for every line of documents, given as line features and whether the document is good.

    The kinds of lines (equal features) have a logistic model, and good and bad documents a share of content lines each. In turn
    every line's probability to be content follows from its kind and from the share of its document's quality, and the model
    and the shares are fitted to these probabilities. The shares stay within their bounds, so a quality never comes to mean its opposite. Good
    and bad documents weigh alike. Without documents of both qualities all lines have the label of their documents.
    """
    some = [(b, good) for b, good in documents if b]
    if len({good for _, good in some}) < 2:
        return [[CONTENT if good else BOILERPLATE] * len(b) for b, good in documents]
    kinds, kind = np.unique(np.concatenate([b for b, _ in some]), return_inverse=True)
    lengths, good = np.array([len(b) for b, _ in some]), np.array([g for _, g in some])
    weight = np.repeat(np.where(good, 1 / good.sum(), 1 / (~good).sum()) / lengths, lengths)
    quality = np.repeat(good, lengths).astype(int)
    # What lines of each kind weigh in bad and in good documents.
    mass = np.stack([np.bincount(kind, weight * (quality == q), len(kinds)) for q in (0, 1)])
    features, shares = matrix(kinds), np.array([np.mean(BAD_SHARES), np.mean(GOOD_SHARES)])
    belief = np.stack([np.zeros(len(kinds)), np.ones(len(kinds))])
    weights = np.zeros(N_FEATURES)
    for _ in range(rounds):
        wanted, size = (mass * belief).sum(axis=0), mass.sum(axis=0)
        for _ in range(4):
            p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
            slope = features.T @ (wanted - size * p) - ridge * weights
            curve = (features * (size * p * (1 - p))[:, None]).T @ features + ridge * np.eye(N_FEATURES)
            step = np.linalg.solve(curve, slope)
            weights = weights + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        score, middle = features @ weights, shares.mean()
        odds = np.log(shares / (1 - shares)) - np.log(middle / (1 - middle))
        belief = 1 / (1 + np.exp(-np.clip(score[None, :] + odds[:, None], -30, 30)))
        shares = (mass * belief).sum(axis=1)
        shares = np.array([np.clip(share, *bounds) for share, bounds in zip(shares, (BAD_SHARES, GOOD_SHARES))])
    found = np.where(belief >= 0.5, CONTENT, BOILERPLATE)[quality, kind]
    labels, at = [], 0
    for b, _ in documents:
        labels.append(found[at : at + len(b)].tolist())
        at += len(b)
    return labels


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text", most_lines: int = TRAIN_LINES) -> Field:
    """A field from all lines of at most ``most`` labelled documents, chosen by a hash of their ids; without any, a field that calls all content.

    ``most_lines`` bounds the lines of all of them; each quality has half. A document that does not fit into what is left is left out whole.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # Half of each quality, so that the rarer one is not drowned.
    chosen = known.where("quality = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
    chosen = chosen.union(known.where("quality <> 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            lines = [line_features(t.as_py() or "")[0] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.int64())), batch.column(2)], ["doc_id", "lines", "quality"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.join(chosen.select(F.col("doc_id").cast("long"), F.col("quality").cast("long")), "doc_id").mapInArrow(describe, "doc_id long, lines array<long>, quality long")
    rows = settled(rows, "training-lines")
    sizes = rows.groupBy("doc_id", "quality").agg(F.sum(F.size("lines")).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    left, taken = {True: most_lines // 2, False: most_lines // 2}, []
    for r in sizes:
        if r.n <= left[bool(r.quality)]:
            left[bool(r.quality)] -= r.n
            taken.append(r.doc_id)
    found = sorted((r.doc_id, list(r.lines), r.quality) for r in rows.where(F.col("doc_id").isin(taken)).collect()) if taken else []
    documents = [(lines, bool(quality)) for _, lines, quality in found]
    return Field.trained([(lines, labels) for (lines, _), labels in zip(documents, line_labels(documents))])


def judged(text: str, field: Field) -> tuple[Base, float, bool]:
    """Base counts, content share, and whether the text is kept."""
    base = base_counts(text)
    bits, sizes = line_features(text)
    total = sum(sizes)
    share = sum(s for s, y in zip(sizes, field.viterbi(bits)) if y == CONTENT) / total if total else 0.0
    return base, share, not base.failed() and share >= LEAST_CONTENT


def line_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept``.

    Null texts count as empty; texts without words fail the base rules. Rows are not combined, other
    columns are ignored; an empty table gives no rows. Without labels every line is content. Documents
    are not shuffled but for the join that picks the training texts.
    """
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [judged(t.as_py() or "", sent.value) for t in batch.column(1)]
            columns = [pa.array([b[k] for b, _, _ in found], pa.int64()) for k in range(5)]
            columns += [pa.array([b.failed() for b, _, _ in found], pa.bool_()), pa.array([s for _, s, _ in found], pa.float64()), pa.array([k for _, _, k in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *Base._fields, "base_failed", "content_share", "kept"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        judge, "doc_id long, " + ", ".join(f"{f} long" for f in Base._fields) + ", base_failed boolean, content_share double, kept boolean"
    )


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; see :func:`line_quality`."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([judged(t.as_py() or "", sent.value)[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(select, docs.schema)
