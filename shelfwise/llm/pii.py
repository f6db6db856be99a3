"""Personal data by base rules and a skip-chain conditional random field.

Base rules find emails, addresses, card and phone numbers; their spans always
stay. The field reads each document's tokens with a digit or an @ (all other
tokens are `other` for certain). Neighbouring tokens share transition
potentials; tokens that repeat or resemble an earlier one (equal digits, equal
address apart from case) share a skip potential with it, however far away.
Loopy sum-product messages give each token's beliefs over `other` and begin /
inside of each kind. Runs that are labelled with belief `SURE` or more become
further spans if they do not touch a base span and either hold what the kind
asks for or are linked to a token inside a base span of that kind.

Factors are fitted piecewise, with the base spans as distant labels, on at most
`SAMPLE_TOKENS` tokens of documents chosen by hashed id: unary weights by
softmax regression, transitions and skips from smoothed counts.

Defined results: a null text is empty and has no spans; rows that repeat a
doc_id are answered one by one; an empty table gives no rows; without any
token to learn from no spans are added. Extra columns are ignored. Offsets are
code points, ends exclusive. Counts are those of the base spans.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.sampling import hash_sample
from shelfwise.llm.tokens import slices

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 4_000
SAMPLE_TOKENS = 100_000
SURE = 0.9
ROUNDS = 15
LABELS = 1 + 2 * len(KINDS)  # other, then begin and inside of each kind
SMOOTH = 0.1  # prior weight of independence, as a share of the neighbours seen
AGREE = 20.0  # prior weight of equal kinds across a skip

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORTH = re.compile(r"[0-9@]")
_EDGES = ".,;:!?()[]{}<>\"'"


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", domain.end() if domain else at + 1)
    return out


def is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def is_card(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start, then kind."""
    out = _emails(text)
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if is_ip(m[0])]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if is_card(digits_of(m[0]))]
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


class Tokens(NamedTuple):
    """Tokens of a document with a digit or an @; `joined` tells if nothing stands between one and the one before."""

    text: list[str]
    start: list[int]
    joined: list[bool]


def tokens_of(text: str) -> Tokens:
    out = Tokens([], [], [])
    before = None
    for i, m in enumerate(re.finditer(r"\S+", text)):
        if _WORTH.search(m[0]):
            out.text.append(m[0])
            out.start.append(m.start())
            out.joined.append(before == i - 1)
            before = i
    return out


def _runs(joined: list[bool]) -> list[tuple[int, int]]:
    cuts = [i for i, j in enumerate(joined) if not j] + [len(joined)]
    return list(zip(cuts, cuts[1:]))


_SIZES = (0, 1, 2, 3, 4, 5, 7, 10, 14, 20)
FEATURES = len(_SIZES) + 22


def features_of(tokens: Tokens) -> list[list[int]]:
    """The features that each token has, by number."""
    bare = [t.strip(_EDGES) for t in tokens.text]
    digits = [digits_of(t) for t in bare]
    n, extra = len(bare), len(_SIZES)
    found: list[set[int]] = []
    for t, raw, d in zip(bare, tokens.text, digits):
        size = max(i for i, least in enumerate(_SIZES) if len(d) >= least)
        domain = _DOMAIN.fullmatch(t.partition("@")[2]) if "@" in t else None
        tests = ("@" in t, bool(domain) and t[0] != "@", "." in t, t.count(".") == 3 and not t.strip("0123456789."),
                 t.count(".") == 3 and not t.strip("0123456789.") and "" not in t.split(".") and is_ip(t),
                 raw.startswith("+"), "(" in raw, "-" in t, any(c.isalpha() for c in t), t.isdigit(), is_card(d))
        found.append({size} | {extra + i for i, test in enumerate(tests) if test} | {extra + 11})
    for a, b in _runs(tokens.joined):
        for i in range(a, b):
            if i > a:
                found[i] |= {extra + 12} | ({extra + 13} if tokens.text[i - 1].startswith("+") else set())
            if i + 1 < b:
                found[i] |= {extra + 14} | ({extra + 15} if "(" in tokens.text[i + 1] else set())
            if tokens.text[i].startswith("+"):
                total, j = 0, i
                while j < b and total + len(digits[j]) <= 15 and (j == i or not tokens.text[j].startswith("+")):
                    total += len(digits[j])
                    found[j].add(extra + (16 if j == i else 17))
                    j += 1
                if total >= 10:
                    for k in range(i, j):
                        found[k].add(extra + (18 if k == i else 19))
            whole = ""
            for j in range(i, min(b, i + 5)):
                if bare[j].strip("0123456789-"):
                    break
                whole += digits[j]
                if j > i and is_card(whole):
                    found[i].add(extra + 20)
                    for k in range(i + 1, j + 1):
                        found[k].add(extra + 21)
    assert n == len(found)
    return [sorted(f) for f in found]


def skip_key(token: str) -> str:
    """What resembling tokens have in common; empty for tokens that link to none."""
    bare = token.strip(_EDGES).lower()
    digits = digits_of(bare)
    return bare if "@" in bare[1:-1] else digits if len(digits) >= 6 else ""


def skip_edges(tokens: Tokens) -> list[tuple[int, int]]:
    """Each token with a key, and the next one that has it too."""
    last: dict[str, int] = {}
    out = []
    for i, token in enumerate(tokens.text):
        key = skip_key(token)
        if key:
            if key in last:
                out.append((last[key], i))
            last[key] = i
    return out


def token_labels(tokens: Tokens, spans: list[Span]) -> list[int]:
    """0, or begin / inside of the span that a token lies in."""
    out = [0] * len(tokens.text)
    at = 0
    for kind, start, end in spans:
        while at and tokens.start[at] > start:
            at -= 1
        while at < len(out) and tokens.start[at] + len(tokens.text[at]) <= start:
            at += 1
        j = at
        while j < len(out) and tokens.start[j] < end:
            if not out[j]:
                out[j] = 1 + 2 * KINDS.index(kind) + (j > at)
            j += 1
    return out


def unclear(text: str, tokens: Tokens) -> list[bool]:
    """Tokens inside a match that was dropped for too many digits: it may hold several items, so nothing is
    learned from it."""
    wide = [m.span() for pattern, most in ((_CARD, 19), (_PHONE, 15)) for m in pattern.finditer(text)
            if len(digits_of(m[0])) > most]
    return [any(a < start + len(token) and start < b for a, b in wide)
            for token, start in zip(tokens.text, tokens.start)]


class Field(NamedTuple):
    """Log potentials: unary (features x labels), transitions and skips (labels x labels)."""

    unary: np.ndarray
    move: np.ndarray
    skip: np.ndarray


def fit_field(features: list[list[int]], labels: np.ndarray, moves: np.ndarray, skips: np.ndarray) -> Field:
    """Piecewise estimates. `moves` and `skips`: pairs of labels of neighbours and of linked tokens."""
    x = np.zeros((len(features), FEATURES))
    for row, found in zip(x, features):
        row[found] = 1
    w = np.zeros((FEATURES, LABELS))
    y = np.eye(LABELS)[labels]
    pace = np.full_like(w, 1e-6)
    for _ in range(300):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = x.T @ (p - y) / len(x) + 1e-4 * w
        pace += slope ** 2
        w -= 0.5 * slope / np.sqrt(pace)

    def ratio(pairs: np.ndarray, prior: np.ndarray) -> np.ndarray:
        joint = prior + np.bincount(pairs[:, 0] * LABELS + pairs[:, 1], minlength=LABELS ** 2).reshape(LABELS, LABELS)
        joint = joint / joint.sum()
        return np.log(joint) - np.log(joint.sum(axis=1, keepdims=True)) - np.log(joint.sum(axis=0, keepdims=True))

    share = np.bincount(labels, minlength=LABELS) + 1.0
    share /= share.sum()
    kind = (np.arange(LABELS) + 1) // 2
    agree = np.outer(share, share) + AGREE * (kind[:, None] == kind[None, :]) * np.minimum(share[:, None], share[None, :])
    even = np.outer(share, share) * (10 + SMOOTH * len(moves))
    return Field(w, ratio(moves, even), ratio(skips, agree))


def beliefs(field: Field, features: list[list[int]], chain: np.ndarray, skips: np.ndarray,
            alone: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Loopy sum-product over any number of documents at once: a row of label probabilities per token.

    `chain` and `skips` are pairs of token numbers; `alone` tells which tokens
    have a certain `other` before and after them.
    """
    flat = np.concatenate([np.asarray(f) for f in features])
    first = np.cumsum([0, *(len(f) for f in features[:-1])])
    unary = np.add.reduceat(field.unary[flat], first)
    unary = unary + np.outer(alone[0], field.move[0]) + np.outer(alone[1], field.move[:, 0])
    edges = np.concatenate([chain, skips]).reshape(-1, 2)
    pair = np.concatenate([np.repeat(field.move[None], len(chain), 0), np.repeat(field.skip[None], len(skips), 0)])
    src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    sent = np.zeros((len(src), LABELS))
    for _ in range(ROUNDS if len(src) else 0):
        belief = unary.copy()
        np.add.at(belief, dst, sent)
        told = (belief[src] - sent[back])[:, :, None] + pair
        top = told.max(axis=1)
        new = top + np.log(np.exp(told - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        done = np.abs(new - sent).max() < 1e-4
        sent = 0.5 * sent + 0.5 * new
        if done:
            break
    belief = unary
    np.add.at(belief, dst, sent)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def holds(kind: str, text: str) -> bool:
    """If a text is by itself what a kind asks for."""
    digits = digits_of(text)
    return {"email": lambda: _emails(text) == [("email", 0, len(text))], "ip": lambda: bool(_IP.fullmatch(text)) and is_ip(text),
            "card": lambda: bool(_CARD.fullmatch(text)) and is_card(digits),
            "phone": lambda: bool(_PHONE.fullmatch(text)) and 10 <= len(digits) <= 15}[kind]()


def added_spans(text: str, tokens: Tokens, belief: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans that the field adds to the base spans of a document."""
    label = belief.argmax(axis=1)
    sure = belief.max(axis=1) >= SURE
    known = token_labels(tokens, base)
    linked: dict[str, set[int]] = {}
    for token, y in zip(tokens.text, known):
        if y and skip_key(token):
            linked.setdefault(skip_key(token), set()).add((y + 1) // 2)
    out, i = [], 0
    while i < len(label):
        kind, j = (label[i] + 1) // 2, i + 1
        while kind and j < len(label) and tokens.joined[j] and label[j] == 2 * kind:
            j += 1
        if kind and sure[i:j].all() and not any(known[i:j]):
            head, tail = tokens.text[i], tokens.text[j - 1]
            start = tokens.start[i] + len(head) - len(head.lstrip(_EDGES))
            end = tokens.start[j - 1] + len(tail.rstrip(_EDGES))
            name = KINDS[kind - 1]
            if start < end and (holds(name, text[start:end])
                                or any(kind in linked.get(skip_key(t), ()) for t in tokens.text[i:j] if skip_key(t))):
                out.append((name, start, end))
        i = j
    return out


def find_spans(texts: list[str | None], field: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """(base, all) spans of each text; one graph of messages for all of them."""
    base = [base_spans(t) if t else [] for t in texts]
    if field is None:
        return [(b, b) for b in base]
    tokens = [tokens_of(t) if t else Tokens([], [], []) for t in texts]
    features, chain, skips, joined, at = [], [], [], [], [0]
    for t in tokens:
        features += features_of(t)
        chain += [(at[-1] + i - 1, at[-1] + i) for i, j in enumerate(t.joined) if j]
        skips += [(at[-1] + a, at[-1] + b) for a, b in skip_edges(t)]
        joined += t.joined
        at.append(len(joined))
    if not features:
        return [(b, b) for b in base]
    before = ~np.array(joined)
    after = np.append(before[1:], True)
    found = beliefs(field, features, np.array(chain, int).reshape(-1, 2), np.array(skips, int).reshape(-1, 2),
                    (before.astype(float), after.astype(float)))
    out = []
    for i, (text, t, b) in enumerate(zip(texts, tokens, base)):
        more = added_spans(text, t, found[at[i]:at[i + 1]], b) if text else []
        out.append((b, sorted(b + more, key=lambda s: (s[1], KINDS.index(s[0])))))
    return out


def _worth(docs: DataFrame, *columns: str) -> DataFrame:
    """Texts without a digit or an @ hold nothing and need not reach Python."""
    text = F.col("text").cast("string")
    return docs.select(*columns, F.when(text.rlike("[0-9@]"), text).alias("text"))


def train_field(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Field | None:
    """Fit the field on a bounded sample; None if no document has a token to learn from."""

    def batches(found):
        for batch in found:
            rows = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                tokens = tokens_of(text)
                labels = token_labels(tokens, base_spans(text))
                left_out = unclear(text, tokens)
                skips = {b: a for a, b in skip_edges(tokens)}
                for i, own in enumerate(features_of(tokens)):
                    if left_out[i]:
                        continue
                    moves = [(labels[i - 1], labels[i])] if tokens.joined[i] and not left_out[i - 1] else []
                    if not tokens.joined[i]:
                        moves.append((0, labels[i]))
                    if i + 1 == len(labels) or not tokens.joined[i + 1]:
                        moves.append((labels[i], 0))
                    rows.append({"key": key, "i": i, "features": own, "label": labels[i],
                                 "moves": [a * LABELS + b for a, b in moves],
                                 "linked": labels[skips[i]] if i in skips and not left_out[skips[i]] else None})
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    kinds = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("features", pa.list_(pa.int32())),
                       ("label", pa.int32()), ("moves", pa.list_(pa.int32())), ("linked", pa.int32())])
    worth = _worth(docs, "doc_id").where("text is not null")
    sample = hash_sample(worth, sample_docs, ["doc_id", "text"], wide=8, count=docs.count())  # few are worth it
    rows = (sample.select(F.xxhash64("doc_id", "text").alias("key"), "text")
            .mapInArrow(batches, "key long, i int, features array<int>, label int, moves array<int>, linked int")
            .orderBy("key", "i").limit(sample_tokens).toArrow())
    if not rows.num_rows:
        return None
    labels = rows["label"].to_numpy()
    linked = rows["linked"].to_pylist()
    skips = np.array([(a, b) for a, b in zip(linked, labels) if a is not None], int).reshape(-1, 2)
    moves = np.array([m for found in rows["moves"].to_pylist() for m in found], int)
    return fit_field(rows["features"].to_pylist(), labels, np.stack([moves // LABELS, moves % LABELS], 1), skips)


def joined_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text", 1 << 20):
                spans = find_spans(part.column("text").to_pylist(), field)
                counts = [pa.array([sum(s[0] == kind for s in b) for b, _ in spans], pa.int64()) for kind in KINDS]
                digests = [hashlib.sha256(joined_spans(b).encode()).hexdigest() for b, _ in spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array(digests, pa.string()),
                     pa.array([joined_spans(s) for _, s in spans], pa.string())],
                    ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    rows = _worth(docs, "doc_id")
    return rows.mapInArrow(batches, f"doc_id {dict(rows.dtypes)['doc_id']}, n_email long, n_ip long, n_card long, "
                                    "n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """`text` with each span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, field: Field | None) -> DataFrame:
    """`docs` with personal data masked in `text`; `n_chars`, if there, is counted anew for changed texts."""

    def batches(found):
        for batch in found:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                worth = [t if t and _WORTH.search(t) else None for t in texts]
                clean = [masked(t, spans) if spans else t
                         for t, (_, spans) in zip(texts, find_spans(worth, field))]
                part = part.set_column(part.schema.get_field_index("text"), "text",
                                       pa.array(clean, part.schema.field("text").type))
                at = part.schema.get_field_index("n_chars")
                if at >= 0:
                    sizes = [n if t == c else len(c) for n, t, c in zip(part.column(at).to_pylist(), texts, clean)]
                    part = part.set_column(at, "n_chars", pa.array(sizes, part.schema.field(at).type))
                yield part

    return docs.mapInArrow(batches, docs.schema)
