"""Personal data by patterns plus a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers in whole texts. The random field
then labels the tokens that hold a digit or an @ (any other token can only be outside). Neighbouring tokens
share transition potentials; distant tokens with the same content - the same digits (the last seven of longer
phone-like ones) or the same lower-cased letters - share skip potentials, each occurrence with the next one,
so edges grow with the tokens. A number written with spaces is one occurrence: its tokens are linked to its last.
Tokens inside pattern spans are clamped to their kind, and loopy message passing over all documents of a batch
at once carries labels to the other occurrences of a document. Tokens whose marginal exceeds ``THRESHOLD``
become further spans beside the patterns'.

Weights are learned by pseudo-likelihood on a bounded sample of documents: whole, the ``max_docs`` with the
smallest hash among those that hold a digit or @, with the pattern spans as labels; features describe only a
token's shape. Tokens that repeat a labelled one are neither inside nor outside for certain, so they are left out.
Links are learned from repeats known by construction: each number of a sample document is written once more at
its end, in turn bare, hyphenated, dotted and spaced, with and without its area code.

Defined results: null text is empty text without spans; a null doc_id stays null; repeated rows are labelled
row by row; empty tables give empty results; texts of any length are read whole in linear time; extra columns are dropped.
"""
from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_id, prepare, smallest_hashes

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0: outside
THRESHOLD = 0.9
MAX_DOCS = 4000
TOLERANCE = 1e-3
ROUNDS = 10  # sweeps without progress before a document's steps are halved
MIN_STEP = 1 / 1024

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a failing match cannot begin later in the same digit run, so only the run's begin is tried
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_ANY = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[^0-9]+")
_EDGE = ".,;:!?\"'()[]{}<>|#$%&*^~`=/\\"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    at = text.find("@")
    free = 0  # end of the last match
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    if not _ANY.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _DIGITS.sub("", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


def _shape(token: str) -> list[int]:
    """Active features of a token."""
    core = token.strip(_EDGE)
    digits = _DIGITS.sub("", core)
    n = len(digits)
    size = next(i for i, top in enumerate((0, 2, 4, 7, 11, 15, 19, 1 << 60)) if n <= top)
    plain = all(c in "0123456789+-. ()" for c in core)
    parts = core.split(".")
    host = core.rpartition("@")[2]
    flags = (True, "@" in core, "@" in core[1:] and "." in host[1:-1], plain, plain and core.startswith("+"), token.startswith("("),
             _is_ip(core), plain and 16 <= n <= 19 and luhn(digits),
             any(c.isalpha() for c in core), len(core) >= 16 and all(c in "0123456789abcdefABCDEF" for c in core), "=" in token, '"' in token,
             plain and "-" in core[1:], len(parts) == 2, n == len(core) and n > 0)
    return [i for i, f in enumerate(flags) if f] + [len(flags) + size]


FEATURES = 15 + 8


def _is_ip(core: str) -> bool:
    parts = core.split(".")
    return len(parts) == 4 and all(p.isdigit() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)


def _number_key(digits: str) -> str:
    return "n" + (digits[-7:] if len(digits) <= 15 else digits)


def _same_as(token: str) -> str | None:
    """What makes distant tokens similar."""
    core = token.strip(_EDGE)
    digits = _DIGITS.sub("", core)
    if "@" in core or _is_ip(core):
        return core.lower()
    if len(digits) >= 7 and not any(c.isalpha() for c in core):
        return _number_key(digits)
    return core.lower() if len(core) >= 6 else None


@dataclass
class Graph:
    """Tokens of many documents: places, features, labels of the patterns (0 none) and edges."""

    doc: list
    start: list
    end: list
    shape: list
    base: list
    chain: list
    skip: list


def build_graph(texts: list[str], spans: list[list]) -> Graph:
    g = Graph([], [], [], [], [], [], [])
    for d, (text, own) in enumerate(zip(texts, spans)):
        if not _ANY.search(text):
            continue
        marks = sorted((a, b, k + 1) for k, a, b in own)
        # the digits of the numbers in pattern spans, by key
        known = {_number_key(n): n for n in sorted((_DIGITS.sub("", text[a:b]) for k, a, b in own if k >= 2), key=len)}
        last_end, seen, p, first = None, {}, 0, len(g.doc)
        for m in _TOKEN.finditer(text):
            a, b = m.span()
            i = len(g.doc)
            while p < len(marks) and marks[p][1] <= a:
                p += 1
            label, q = 0, p
            while q < len(marks) and marks[q][0] < b:
                label = label or (marks[q][2] if marks[q][1] > a else 0)
                q += 1
            g.doc.append(d)
            g.start.append(a)
            g.end.append(b)
            g.shape.append(_shape(m[0]))
            g.base.append(label)
            if last_end is not None and a - last_end <= 2:
                g.chain.append((i - 1, i))
            last_end = b
            key = _same_as(m[0])
            if known:
                key, own_tokens = _spaced(text, g, first, i, known, key)
                g.skip += [(j, i) for j in own_tokens]
            if key is not None:
                if key in seen:
                    g.skip.append((seen[key], i))
                seen[key] = i
    return g


def _spaced(text: str, g: Graph, first: int, last: int, known: dict, key: str | None) -> tuple[str | None, list[int]]:
    """Key and earlier tokens of the number written with spaces that ends at token ``last``, if its digits are those
    of a known one (or end like it)."""
    digits, tokens, found = "", [], (key, [])
    for j in range(last, max(first, last - 19) - 1, -1):
        core = text[g.start[j]:g.end[j]].strip(_EDGE)
        if not all(c in "0123456789+-. " for c in core) or j < last and text[g.end[j]:g.start[j + 1]] != " ":
            break
        digits = _DIGITS.sub("", core) + digits
        whole = known.get(_number_key(digits)) if len(digits) >= 7 else None
        if j < last:
            tokens.append(j)
        if whole and (whole.endswith(digits) or digits.endswith(whole)):
            found = _number_key(digits), list(tokens)
        if len(digits) > 19:
            break
    return found


@dataclass
class Field:
    """Weights: tokens (features x labels), neighbours and similar tokens (labels x labels)."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, shapes: list) -> np.ndarray:
        sizes = np.fromiter(map(len, shapes), np.int64, len(shapes))
        flat = np.fromiter((f for s in shapes for f in s), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.node[flat], np.cumsum(sizes) - sizes, axis=0)

    def marginals(self, g: Graph) -> np.ndarray:
        """Loopy sum-product in log space; clamped tokens keep their label.

        Every edge leads to a later token, so a sweep passes the edges forward in the order of their begins and
        backward in that of their ends: labels cross a chain of any length in one sweep. A document is swept until
        no message changes by TOLERANCE; only if its changes stop shrinking over ROUNDS sweeps are its steps halved,
        and it is given up below MIN_STEP."""
        theta = self.unary(g.shape)
        base = np.array(g.base)
        known = np.flatnonzero(base)
        theta[known] = -30.0
        theta[known, base[known]] = 0.0
        edges = np.array(g.chain + g.skip, np.int64).reshape(-1, 2)
        if not len(edges):
            return _normal(theta)
        a, b = edges.T
        kind = np.repeat([0, 1], [len(g.chain), len(g.skip)])
        pair = np.stack([self.chain, self.skip])
        turned = pair.transpose(0, 2, 1)
        doc = np.array(g.doc)[a]
        ahead, back = _depths(a, b, len(theta)), _depths(len(theta) - 1 - b, len(theta) - 1 - a, len(theta))
        forth, home = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))  # to the later token, to the earlier one
        moved = np.zeros(len(edges))
        docs = int(doc.max()) + 1
        step, best, stale = np.ones(docs), np.full(docs, np.inf), np.zeros(docs, int)
        live = np.arange(len(edges))
        while len(live):
            belief = _beliefs(theta, a, b, forth, home)
            moved[:] = 0
            for depth, begin, end, sent, other, pairs in ((ahead, a, b, forth, home, np.exp(pair)), (back, b, a, home, forth, np.exp(turned))):
                order = live[np.argsort(depth[live], kind="stable")]
                cuts = [0, *(np.flatnonzero(np.diff(depth[order])) + 1).tolist(), len(order)]
                source, target, weight, rate = begin[order], end[order], kind[order], step[doc[order], None]
                for i, j in zip(cuts, cuts[1:]):
                    e = order[i:j]
                    out = belief[source[i:j]] - other[e]
                    out = np.exp(out - out.max(axis=1, keepdims=True))
                    new = np.log((out[:, None] @ pairs[weight[i:j]])[:, 0])
                    new -= new.max(axis=1, keepdims=True)
                    delta = new - sent[e]
                    moved[e] = np.maximum(moved[e], np.abs(delta).max(axis=1))
                    delta *= rate[i:j]
                    sent[e] += delta
                    np.add.at(belief, target[i:j], delta)
            change = np.zeros(docs)
            np.maximum.at(change, doc, moved)
            shrunk = change < 0.9 * best
            best = np.where(shrunk, change, best)
            stale = np.where(shrunk, 0, stale + 1)
            step = np.where(stale >= ROUNDS, step / 2, step)
            stale[stale >= ROUNDS] = 0
            live = live[((change >= TOLERANCE) & (step >= MIN_STEP))[doc[live]]]
        return _normal(_beliefs(theta, a, b, forth, home))


def _depths(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Per edge a < b: the edges on the longest way to its begin."""
    depth = [0] * n
    order = np.argsort(b, kind="stable")
    for x, y in zip(a[order].tolist(), b[order].tolist()):
        depth[y] = max(depth[y], depth[x] + 1)
    return np.array(depth)[a]


def _beliefs(theta: np.ndarray, a: np.ndarray, b: np.ndarray, forth: np.ndarray, home: np.ndarray) -> np.ndarray:
    belief = theta.copy()
    np.add.at(belief, b, forth)
    np.add.at(belief, a, home)
    return belief


def _normal(belief: np.ndarray) -> np.ndarray:
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def prior() -> Field:
    """Where learning starts and what it is pulled to: similar tokens share a label."""
    node = np.zeros((FEATURES, LABELS))
    node[0, 0] = 3.0
    return Field(node, np.zeros((LABELS, LABELS)), np.eye(LABELS) * 4.0)


def _repeated(digits: str, style: int) -> str:
    """A number in another spelling."""
    if len(digits) > 15:
        return ("." if style % 2 else "").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    parts = [local[:-7], local[-7:-4], local[-4:]]
    return ("".join(parts), "-".join(parts[1:]), ".".join(parts).lstrip("."), " ".join(parts).lstrip(), "-".join(parts).lstrip("-"),
            ".".join(parts[1:]))[style]


def _with_repeats(texts: list[str]) -> tuple[list[str], list[list]]:
    """Texts with each number of their pattern spans once more at the end; all spans."""
    out, spans, style = [], [], 0
    for t in texts:
        own = base_spans(t)
        pieces, at, extra = [t], len(t), []
        for k, a, b in own:
            if k >= 2:
                again = _repeated(_DIGITS.sub("", t[a:b]), style % 6)
                style += 1
                extra.append((k, at + 4, at + 4 + len(again)))
                pieces += ["    ", again]
                at += 4 + len(again)
        out.append("".join(pieces))
        spans.append(own + extra)
    return out, spans


def _unknown(y: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Outside tokens that similar tokens tie to a labelled one."""
    tied = (y > 0).tolist()
    for edges in (skip.tolist(), skip[::-1].tolist()) * 2:
        for a, b in edges:
            tied[a] = tied[b] = tied[a] or tied[b]
    return np.array(tied) & (y == 0)


def learn(texts: list[str], steps: int = 300, rate: float = 0.5, l2: float = 1e-4) -> Field:
    """Pseudo-likelihood: each known token given its shape and its known neighbours' labels."""
    field = prior()
    g = build_graph(*_with_repeats(texts))
    n = len(g.doc)
    if not n:
        return field
    x = np.zeros((n, FEATURES))
    for i, s in enumerate(g.shape):
        x[i, s] = 1
    y = np.array(g.base)
    chain, skip = (np.array(e, np.int64).reshape(-1, 2) for e in (g.chain, g.skip))
    sure = ~_unknown(y, skip)
    chain, skip = (e[sure[e].all(axis=1)] for e in (chain, skip))
    one = np.eye(LABELS)[y]
    start = prior()
    for _ in range(steps):
        s = x @ field.node
        for e, w in ((chain, field.chain), (skip, field.skip)):
            np.add.at(s, e[:, 1], w[y[e[:, 0]]])
            np.add.at(s, e[:, 0], w.T[y[e[:, 1]]])
        d = (one - _normal(s)) * sure[:, None]
        field.node += rate * (x.T @ d / n * 20 - l2 * (field.node - start.node))
        for e, w, w0 in ((chain, field.chain, start.chain), (skip, field.skip, start.skip)):
            if len(e):
                grad = one[e[:, 0]].T @ d[e[:, 1]] + d[e[:, 0]].T @ one[e[:, 1]]
                w += rate * (grad / n * 20 - l2 * (w - w0))
    return field


def label_texts(field: Field, texts: list[str]) -> list[tuple[list, list]]:
    """Per text: pattern spans, and all spans."""
    base = [base_spans(t) for t in texts]
    g = build_graph(texts, base)
    added: list[list] = [[] for _ in texts]
    if g.doc:
        p = field.marginals(g)
        best = p.argmax(axis=1)
        free = (np.array(g.base) == 0) & (best > 0) & (p.max(axis=1) > THRESHOLD)
        run = None
        for i in np.flatnonzero(free).tolist():
            d, k = g.doc[i], int(best[i]) - 1
            a, b = g.start[i], g.end[i]
            core = texts[d][a:b].strip(_EDGE) or texts[d][a:b]
            a = texts[d].index(core, a)
            b = a + len(core)
            if run and run[0] == (d, i - 1, k) and a - run[1][2] <= 2:
                run[1][2] = b  # neighbours of one kind are one span
                run = ((d, i, k), run[1])
            else:
                span = [k, a, b]
                added[d].append(span)
                run = ((d, i, k), span)
    return [(b, sorted(b + [tuple(s) for s in a])) for b, a in zip(base, added)]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _redacted(text: str, spans) -> str:
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
            at = b
        else:
            at = max(at, b)
    return "".join(out) + text[at:]


def _label_batches(bc, redact: bool):
    def run(batches):
        field = bc.value
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            found = label_texts(field, texts)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            sha = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            columns = [b.column("doc_id"), *counts, sha, pa.array([_joined(s) for _, s in found], pa.string())]
            if redact:
                columns.append(pa.array([_redacted(t, s) for t, (_, s) in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"] + ["redacted"] * redact)
    return run


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Field:
    """The sample comes to the driver as the surroundings of its tokens."""
    prepare(docs.sparkSession)
    held = docs.select(F.xxhash64("text").alias("h"), "text").where(F.col("text").rlike("[0-9@]"))
    chosen = F.broadcast(smallest_hashes(held.select("h"), max_docs))  # at most max_docs numbers
    sample = held.join(chosen, "h").mapInArrow(_surroundings, "h long, text string").groupBy("h").agg(F.min("text").alias("text")).orderBy("h")
    return learn([r.text for r in sample.collect()])


def _surroundings(batches):
    for b in batches:
        out = []
        for t in b.column("text").to_pylist():
            pieces, at = [], -1
            for m in _TOKEN.finditer(t):
                a, e = max(m.start() - 20, at), min(m.end() + 20, len(t))
                pieces.append(t[a:e] if a == at else "\n " + t[max(a, 0):e])
                at = e
            out.append("".join(pieces))
        yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(out, pa.string())], names=["h", "text"])


def find_pii(docs: DataFrame, field: Field, redact: bool = False) -> DataFrame:
    """doc_id, counts and digest of the pattern spans, all spans, and with ``redact`` the text with spans masked."""
    spark = docs.sparkSession
    prepare(spark)
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string" + ", redacted string" * redact
    return docs.select(long_id(), "text").mapInArrow(_label_batches(spark.sparkContext.broadcast(field), redact), schema)
