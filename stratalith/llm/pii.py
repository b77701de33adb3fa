"""Personal data by weak supervision.

Base rules find e-mail addresses, IP addresses, card and phone numbers; what they find is always
reported. Wider patterns propose further candidates. On every candidate several labelers vote for or
against it or abstain: patterns, gazetteers (top-level domains, country codes, card prefixes, reserved
networks) and words of context. Expectation-maximisation estimates from the agreement of the votes,
without labels, how far each labeler can be trusted. Its posteriors then train the span classifier, a
logistic regression on votes and shape, which alone decides on the candidates beyond the base.

Much of what the wide patterns propose is nothing personal: dates, versions, book and order numbers. It stays among the candidates,
so that the votes against it are seen. A corpus may hold few of them; so the tables of votes start
from a weak belief that labelers are right more often than not, and the classifier is also trained on votes drawn from
the tables themselves, in which all combinations occur.
"""

from __future__ import annotations

import ipaddress
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import ship_package

KINDS = ("email", "ip", "card", "phone")
# Probability from which a candidate beyond the base is reported.
LEAST = 0.9
# Candidates of either truth that the belief in the labelers counts as, and the ridge of the classifier.
BELIEF, RIDGE = 8.0, 1e-4
# Characters before a candidate in which context words are looked for.
CONTEXT = 40

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wider patterns of candidates; group 1 is the span.
_AT, _DOT = r"(?:@|\x20?[\[({]\x20?at\x20?[\])}]\x20?)", r"(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)"
_MORE = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])([A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}{_AT}[A-Za-z0-9-]{{1,63}}{_DOT}[A-Za-z]{{2,24}}(?:{_DOT}[A-Za-z]{{2,24}})?)(?![A-Za-z0-9@-])", re.I),
    "ip": re.compile(r"(?<![0-9A-Za-z.:])((?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}:(?:[0-9A-Fa-f]{1,4}:){0,5}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:\x20?[\[(]\.[\])]\x20?[0-9]{1,3}){3})(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9.+-])([0-9]{14,19}|[0-9]{4}([\x20./_-])[0-9]{4}\2[0-9]{4}\2[0-9]{2,7}|[0-9]{4}([\x20./_-])[0-9]{6}\3[0-9]{4,5})(?![0-9]|[.-][0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+.-])((?:(?:00|\+)[1-9][0-9]{0,2}[\x20./-]?)?(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[\x20./-][0-9]{2,5}){1,4})(?![0-9A-Za-z]|[.-][0-9])"),
}

# What a text must hold for a wider pattern to be worth a search.
_NEEDS = {"email": re.compile(r"@|[\[({]\x20?at", re.I), "ip": re.compile(r":|[\[(]\."), "card": re.compile(r"[0-9]{4}"), "phone": re.compile(r"[0-9]{2}")}
_DIGIT = re.compile(r"[0-9]")

# Gazetteers and context words.
DOMAINS = frozenset("com org net edu gov int info biz io ai app dev co me tv us uk de fr es it nl be ch at se no fi dk pl pt cz ie eu ca mx br ar au nz jp cn in kr za ru ua tr".split())
# Country codes of one and two digits, and the first two digits of those of three.
_SHORT_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
_ZONES = "21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split()
COUNTRIES = tuple(_SHORT_CODES + _ZONES)
CARDS = ("4", "51", "52", "53", "54", "55", "2221", "23", "24", "25", "26", "270", "271", "2720", "34", "37", "6011", "65", "35", "36", "38", "30")
CUES = {
    "email": frozenset("mail email e-mail contact write address inbox mailto correo courriel adresse".split()),
    "ip": frozenset("ip ipv4 ipv6 host server address client login dns gateway".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte kreditkarte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax whatsapp sms telefon handy téléphone teléfono móvil".split()),
}
AGAINST = frozenset("version isbn issn order invoice sku no number id page chapter section total price build release date year figure table".split())
_WORD = re.compile(r"[^\W_][\w-]*")
# Networks of IPv6 that are given out: translated, global, of a site, of a link, groups.
NETWORKS = tuple(map(ipaddress.IPv6Network, ("64:ff9b::/96", "2000::/3", "fc00::/7", "fe80::/10", "ff00::/8")))
# Numbers without country code: three groups of 3, 3 and 4 digits, or an area code with its leading zero and any groups,
# or five pairs.
_NATIONAL = re.compile(r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|0[1-9][0-9]{1,3}(?:[ ./-][0-9]{2,5}){1,4}|0[1-9](?:[ .-][0-9]{2}){4}")

LABELERS = ("base rule", "pattern", "gazetteer", "checksum", "cue before", "other before", "edges", "variety")
# What the vote tables of the labelers after the first start from: the chances of a vote against, none and for, on candidates that
# are nothing personal and on those that are. A wrong form or checksum speaks against more than any word speaks for.
BELIEVED = np.array([
    [[0.70, 0.10, 0.20], [0.02, 0.08, 0.90]],
    [[0.50, 0.30, 0.20], [0.10, 0.30, 0.60]],
    [[0.60, 0.35, 0.05], [0.02, 0.58, 0.40]],
    [[0.01, 0.89, 0.10], [0.01, 0.59, 0.40]],
    [[0.30, 0.69, 0.01], [0.05, 0.94, 0.01]],
    [[0.30, 0.01, 0.69], [0.10, 0.01, 0.89]],
    [[0.20, 0.01, 0.79], [0.05, 0.01, 0.94]],
])


class Span(NamedTuple):
    kind: str
    start: int
    end: int


class Candidate(NamedTuple):
    span: Span
    base: bool
    votes: tuple[int, ...]
    shape: int


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def ipv6(text: str) -> ipaddress.IPv6Address | None:
    try:
        return ipaddress.IPv6Address(text)
    except ValueError:
        return None


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap their own kind, without those that fail their test."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        # Every address ends its local part at a sign of its own, so the signs are tried in turn.
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            free = match.end()
            found.append(Span("email", start, free))
        at = text.find("@", max(at + 1, free))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(Span("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_digits(m[0])) <= 15:
            found.append(Span("phone", m.start(), m.end()))
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span.start, KINDS.index(span.kind), span.end


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def _votes(text: str, span: Span, base: bool) -> tuple[int, ...]:
    """One vote of each of LABELERS: 1 for personal data, -1 against, 0 for none."""
    body = text[span.start : span.end]
    digits = _digits(body)
    before = [w.lower() for w in _WORD.findall(text[max(0, span.start - CONTEXT) : span.start])[-4:]]
    pattern = gazetteer = checksum = 0
    if span.kind == "email":
        plain = re.sub(_DOT, ".", re.sub(_AT, "@", body, count=1, flags=re.I), flags=re.I)
        pattern = 1 if re.fullmatch(r"[\w.%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", plain) else -1
        top = plain.rpartition(".")[2].lower()
        # Every country has a domain of two letters.
        gazetteer = 1 if top in DOMAINS or len(top) == 2 else -1
    elif span.kind == "ip" and ":" in body:
        address = ipv6(body)
        gazetteer = 1 if address and any(address in n for n in NETWORKS) else -1 if "::" in body else 0
        # Names of programs such as "face::bed" have the form too, so a compressed address must also be of a network.
        pattern = 1 if address and gazetteer >= 0 else -1
    elif span.kind == "ip":
        parts = re.findall(r"[0-9]+", body)
        pattern = 1 if (len(parts) == 4 and all(int(p[:9]) <= 255 and (p == "0" or p[0] != "0") for p in parts)) else -1
        gazetteer = -1 if parts[0] in ("0", "255") or (len(parts) == 4 and all(len(p) == 1 for p in parts)) else 1
    elif span.kind == "card":
        groups = [len(x) for x in re.split(r"[^0-9]", body) if x]
        pattern = 1 if groups in ([4, 4, 4, 4], [16], [15], [4, 6, 5], [4, 4, 4, 4, 3], [19], [14], [4, 6, 4]) else -1
        gazetteer = 1 if digits.startswith(CARDS) else -1
        checksum = 1 if 14 <= len(digits) <= 19 and luhn(digits) else -1
    else:
        foreign = body.startswith(("+", "00"))
        pattern = 1 if 9 <= len(digits) <= 15 and (foreign or "(" in body or _NATIONAL.fullmatch(body)) else -1
        gazetteer = 0 if not foreign else 1 if digits.removeprefix("00" if body[0] == "0" else "").startswith(COUNTRIES) else -1
        checksum = 0 if re.fullmatch(r"[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}", body) is None else -1
    around = text[span.start - 1 : span.start] + text[span.end : span.end + 1]
    edges = -1 if any(c.isalnum() for c in around) else 1
    variety = -1 if digits and len(set(digits)) <= 2 and len(digits) > 6 else 1
    return (
        1 if base else 0, pattern, gazetteer, checksum, 1 if CUES[span.kind].intersection(before) else 0, -1 if AGAINST.intersection(before) else 0, edges, variety,
    )


def candidates(text: str) -> list[Candidate]:
    """Base spans, and what the wider patterns find beside them."""
    spans = [(s, True) for s in base_spans(text)]
    taken = [(s.start, s.end) for s, _ in spans]
    for kind, pattern in _MORE.items():
        if not _NEEDS[kind].search(text):
            continue
        own: list[tuple[int, int]] = []
        for m in pattern.finditer(text):
            own.append(m.span(1))
        # A span that meets a base span, or one of an earlier kind, is no candidate.
        free, k, at = [], 0, sorted(taken)
        for a, b in own:
            while k < len(at) and at[k][1] <= a:
                k += 1
            if k == len(at) or at[k][0] >= b:
                free.append((a, b))
        spans += [(Span(kind, a, b), False) for a, b in free]
        taken += free
    return [Candidate(s, base, _votes(text, s, base), min(7, len(_digits(text[s.start : s.end])) // 3)) for s, base in spans]


class Classifier:
    """For each kind a logistic regression on the votes (for and against apart) and the shape."""

    def __init__(self, weights: dict[str, np.ndarray], reliabilities: dict[str, np.ndarray]):
        self.weights, self.reliabilities = weights, reliabilities

    @staticmethod
    def features(votes: tuple[int, ...], shape: int) -> np.ndarray:
        v = np.array(votes)
        # Whether the base rule fired is how the base is chosen, so it tells nothing about other candidates.
        v[0] = 0
        return np.concatenate([v > 0, v < 0, np.arange(8) == shape, [True]]).astype(float)

    def probability(self, kind: str, votes: tuple[int, ...], shape: int) -> float:
        if kind not in self.weights:
            return 0.0
        return float(1 / (1 + np.exp(-self.features(votes, shape) @ self.weights[kind])))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of vote patterns, and ``labeler x truth x (against, none, for)`` probabilities, by expectation-maximisation.

    Labelers are in the order of BELIEVED, from which their tables start with the weight of BELIEF candidates of either truth; further ones
    start from nothing. Without rounds the majority of the votes stands.
    """
    posterior = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    start = np.concatenate([BELIEVED, np.full((max(0, votes.shape[1] - len(BELIEVED)), 2, 3), 1 / 3)])[: votes.shape[1]]
    tables = start.copy()
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        for labeler in range(votes.shape[1]):
            for vote in (-1, 0, 1):
                tables[labeler, :, vote + 1] = weight[:, votes[:, labeler] == vote].sum(axis=1)
        tables = tables + BELIEF * start
        tables /= tables.sum(axis=2, keepdims=True)
        posterior = _posterior(votes, tables, _prior(posterior, counts))
    return posterior, tables


def _prior(posterior: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.array([((1 - posterior) * counts).sum() + BELIEF, (posterior * counts).sum() + BELIEF]) / (counts.sum() + 2 * BELIEF)


def _posterior(votes: np.ndarray, tables: np.ndarray, prior: np.ndarray) -> np.ndarray:
    score = np.log(prior)[:, None] + sum(np.log(tables[k][:, votes[:, k] + 1]) for k in range(votes.shape[1]))
    return 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))


def _drawn(tables: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every combination of votes, and its probability by the tables."""
    votes = np.stack(np.meshgrid(*[[-1, 0, 1]] * len(tables), indexing="ij"), axis=-1).reshape(-1, len(tables))
    each = prior[:, None] * np.prod([tables[k][:, votes[:, k] + 1] for k in range(len(tables))], axis=0)
    return votes, each.sum(axis=0)


def trained(patterns: list[tuple[str, tuple[int, ...], int, int]], rounds: int = 60) -> Classifier:
    """From counts of ``(kind, votes, shape)``; a kind without candidates has no classifier.

    A kind has a prior and vote tables of its own; the vote of the base rule, by which the base was chosen, is in none. Half of
    what the regression is trained on are the candidates, the other half the votes that the tables give, with the shapes of the candidates.
    """
    weights, reliabilities = {}, {}
    for kind in KINDS:
        own = sorted((v, s, n) for k, v, s, n in patterns if k == kind)
        if not own:
            continue
        votes, counts = np.array([v[1:] for v, _, _ in own]), np.array([n for _, _, n in own], float)
        posterior, reliabilities[kind] = estimate(votes, counts, rounds)
        tables, prior = reliabilities[kind], _prior(posterior, counts)
        drawn, chance = _drawn(tables, prior)
        guessed = _posterior(drawn, tables, prior) if rounds else 1 / (1 + np.exp(-drawn.sum(axis=1).astype(float)))
        seen = np.stack([Classifier.features(v, s) for v, s, _ in own])
        shapes = (seen[:, 2 * len(LABELERS) : -1] * counts[:, None]).sum(axis=0) / counts.sum()
        none = np.zeros((len(drawn), 1))
        made = np.concatenate([none, drawn > 0, none, drawn < 0, np.repeat(shapes[None], len(drawn), axis=0), none + 1], axis=1)
        x, wanted = np.concatenate([seen, made]), np.concatenate([posterior, guessed])
        share, w = 0.5 * np.concatenate([counts / counts.sum(), chance]), np.zeros(seen.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            slope = x.T @ (share * (wanted - p)) - RIDGE * w
            curve = (x * (share * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
            step = np.linalg.solve(curve, slope)
            w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        weights[kind] = w
    return Classifier(weights, reliabilities)


def learn(docs: DataFrame, text_col: str = "text") -> Classifier:
    """A classifier from the votes on all candidates of all documents.

    Tasks count vote patterns, which are few whatever the corpus: at most three votes of each labeler,
    eight shapes and four kinds. The driver gets one row per pattern.
    """
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update((c.span.kind, c.votes, c.shape) for c in candidates(text.as_py() or ""))
        rows = [(k, ",".join(map(str, v)), s, n) for (k, v, s), n in counts.items()]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.string(), pa.string(), pa.int64(), pa.int64()])], ["kind", "votes", "shape", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "kind string, votes string, shape long, n long")
    rows = rows.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n")).collect()
    return trained([(r.kind, tuple(map(int, r.votes.split(","))), r.shape, r.n) for r in rows])


def spans_of(text: str, classifier: Classifier, least: float = LEAST) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    found = candidates(text)
    base = [c.span for c in found if c.base]
    more = [c.span for c in found if not c.base and classifier.probability(c.span.kind, c.votes, c.shape) >= least]
    return sorted(base, key=_order), sorted(base + more, key=_order)


def personal_data(docs: DataFrame, classifier: Classifier | None = None, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans`` for every row of ``docs``.

    Counts are of base spans. Spans are ``kind:start:end`` in code points, by start and then kind,
    joined by commas. Null texts count as empty. Rows are not combined or shuffled, other columns are
    ignored; an empty table gives no rows. Repeated rows give repeated rows, and their candidates count as often for the classifier.
    Spans of different kinds may overlap in the base; what is added meets no other span. Texts are searched whole, however long.
    """
    import hashlib

    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(classifier or learn(docs, text_col))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of(t.as_py() or "", sent.value, least) for t in batch.column(1)]
            counts = [pa.array([sum(s.kind == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
            texts = [joined(base) for base, _ in found]
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            columns = [pa.array(x, pa.string()) for x in (texts, digests, [joined(every) for _, every in found])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, *columns], ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        find, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, base_sha256 string, spans string"
    )


def replaced(text: str, spans: list[Span]) -> str:
    """``text`` with ``[KIND]`` in place of each span; of spans that overlap, the union goes under the first one's name."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def without_personal_data(docs: DataFrame, classifier: Classifier | None = None, least: float = LEAST, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced by its kind; ``length_col``, if named, gets the new number of characters.

    Null texts stay null, with a null length. Of spans that overlap the union is replaced, under the name of the first. All other columns stay
    as they are; repeated rows stay repeated. Nothing is shuffled; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(classifier or learn(docs, text_col))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [None if (t := x.as_py()) is None else replaced(t, spans_of(t, sent.value, least)[1]) for x in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length_col:
                k = batch.schema.get_field_index(length_col)
                columns[k] = pa.array([len(t) if t is not None else None for t in texts], batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
