"""Periodic runs of words: maximal stretches with a smallest period that repeats at least ``periods`` times.

Method: phase one of Baier's suffix sorter puts each suffix into the group of its longest Lyndon prefix, so the
group contexts' lengths are the Lyndon array without a suffix array. Groups are refined from the highest to the
lowest: the members of a group leave a linked list of open positions, each points to the nearest open position on
its left, and the positions pointed to form new groups right above their old ones, by the number of pointers. This
is done under the order of the word numbers and under its reverse. A run of at least ``periods`` periods holds, under
one of the two orders, its Lyndon root at ``periods - 1`` or more places one period apart; the first such place
that no run found yet covers is extended to both sides by longest common extensions (compared in growing blocks).

Before that, a document is cut at words that cannot lie in a run: all words of a run, and of its extension by a
word, occur at least ``periods`` times in it. So words rarer than that in a stretch cut it, and stretches too short
for a run go; ``ROUNDS`` rounds of this leave little of ordinary prose. Each run lies within one stretch.

Defined results: null or empty text has no words and no runs; repeated rows are documents of their own; a null
doc_id is kept; an empty table gives an empty result; extra columns are ignored; texts of any length are whole (a
task holds about a hundred bytes per word of the longest repetitive stretch).
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import long_id, prepare

ROUNDS = 8
GROUP_WORDS = 1 << 19


def lyndon_array(x: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place."""
    n = len(x)
    names = {v: g for g, v in enumerate(sorted(set(x)))}
    of = [names[v] for v in x]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(of):
        members[g].append(i)
    context = [1] * len(names)
    lower, upper = list(range(-1, len(names) - 1)), [*range(1, len(names)), -1]
    left, right = list(range(-1, n)), [*range(1, n + 1), 0, 0]  # open places; the last slot of right serves place -1
    out = [0] * n
    g = len(names) - 1
    while g >= 0:
        length = context[g]
        pointers: dict[int, int] = {}
        for i in members[g]:
            if of[i] == g:  # not moved on since
                out[i] = length
                j, k = left[i], right[i]
                right[j] = k
                left[k] = j
                if j >= 0:
                    pointers[j] = pointers.get(j, 0) + 1
        if pointers:
            parts: dict[tuple[int, int], list[int]] = {}
            for j, count in pointers.items():  # ascending places
                key = (of[j], count)
                if key in parts:
                    parts[key].append(j)
                else:
                    parts[key] = [j]
            below = old = -1
            for key in sorted(parts) if len(parts) > 1 else parts:
                if key[0] != old:
                    below = old = key[0]
                new = len(members)
                members.append(parts[key])
                context.append(context[old] + key[1] * length)
                above = upper[below]
                lower.append(below)
                upper.append(above)
                upper[below] = new
                if above >= 0:
                    lower[above] = new
                below = new
                for j in parts[key]:
                    of[j] = new
        members[g] = []
        g = lower[g]
    return out


def common_extension(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common prefix."""
    n, total, step = min(len(x), len(y)), 0, 16
    while total < n:
        end = min(total + step, n)
        differ = x[total:end] != y[total:end]
        k = int(differ.argmax())
        if differ[k]:
            return total + k
        total, step = end, min(2 * step, 1 << 16)
    return n


def runs_of(x: np.ndarray, periods: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``periods`` periods and ``shortest`` symbols, sorted."""
    found, n, place = set(), len(x), np.arange(len(x))
    for symbols in (x.tolist(), (-x).tolist()):
        lyndon = np.array(lyndon_array(symbols), np.int64)
        root = place + max(periods - 2, 0) * lyndon < n
        for m in range(1, periods - 1):
            root &= lyndon[np.minimum(place + m * lyndon, n - 1)] == lyndon
        covered: dict[int, int] = {}
        at = np.flatnonzero(root)
        for i, p in zip(at.tolist(), lyndon[at].tolist()):
            if i + p <= covered.get(p, -1):
                continue
            back = common_extension(x[:i][::-1], x[:i + p][::-1]) if i else 0
            ahead = common_extension(x[i:], x[i + p:])
            if back + ahead >= p:
                covered[p] = i + p + ahead
                if back + p + ahead >= max(shortest, periods * p):
                    found.add((i - back, back + p + ahead, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, text: np.ndarray, periods: int, shortest: int):
    """Positions, and per position a stretch number, of all stretches that may hold a run; ``text`` numbers the
    texts that ``words`` are concatenated from."""
    at, part, size = np.arange(len(words)), text, int(words.max(initial=0)) + 1
    for _ in range(ROUNDS):
        if not len(at):
            break
        _, inverse, counts = np.unique(part * size + words[at], return_inverse=True, return_counts=True)
        often = counts[inverse] >= periods
        kept, kept_part = at[often], part[often]
        starts = np.ones(len(kept), bool)
        starts[1:] = (np.diff(kept) != 1) | (np.diff(kept_part) != 0)
        number = np.cumsum(starts) - 1
        long = (np.bincount(number) >= max(shortest, periods))[number] if len(kept) else starts
        at, unchanged = kept[long], bool(often.all() and long.all())
        part = number[long].astype(np.int64)
        if unchanged:
            break
    return at, part


def text_runs(texts: list[str | None], periods: int, shortest: int):
    """Per text: its words and its runs."""
    split = [(t or "").encode().split() for t in texts]
    place: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = np.fromiter((place.setdefault(w, len(place)) for s in split for w in s), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(split)), sizes)
    firsts = np.cumsum(sizes) - sizes
    runs: list[list] = [[] for _ in split]
    at, part = stretches(words, text, periods, shortest)
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else np.zeros(0, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        k = int(text[at[a]])
        first = int(at[a] - firsts[k])
        runs[k] += [(first + s, n, p) for s, n, p in runs_of(words[at[a:b]], periods, shortest)]
    return [(s, sorted(r, key=lambda x: (x[0], x[2]))) for s, r in zip(split, runs)]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def _groups(texts: list):
    """Texts in groups of bounded size (a longer text is a group of its own)."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or "")
        if size >= 8 * GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


FIELDS = "start long, length long, period long"


def find_runs(docs: DataFrame, periods: int = 4, shortest: int = 6, with_text: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli (ties: smallest start, then period;
    null without runs), runs_sha256 and collapsed_sha256 of every whole text of ``docs``; ``with_text`` adds runs
    (array of start, length, period) and collapsed (the text without repeated periods)."""
    if periods < 2:
        raise ValueError("a run has at least two periods")

    def run(batches):
        for b in batches:
            rows, more = [], []
            for group in _groups(b.column("text").to_pylist()):
                for words, runs in text_runs(group, periods, shortest):
                    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
                    kept = collapse(words, runs)
                    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                    rows.append((len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                                 hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
                    if with_text:
                        more.append(([dict(zip(("start", "length", "period"), r)) for r in runs], kept.decode()))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            if with_text:
                struct = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
                columns += [pa.array([m[0] for m in more], struct), pa.array([m[1] for m in more], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=names)
    schema = f"doc_id long, n_runs long, {FIELDS}, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    if with_text:
        schema += f", runs array<struct<{FIELDS.replace(' long', ': long')}>>, collapsed string"
        names += ["runs", "collapsed"]
    prepare(docs.sparkSession)
    return docs.select(long_id(), "text").mapInArrow(run, schema)


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by the CRC of its id) gets a periodic tail made of its own words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    planted = F.expr("""array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')""")
    return (docs.select(long_id(), "text").withColumn("h", h)
            .withColumn("words", F.when(F.col("h") % 10 == 0, words))
            .withColumn("n", F.size("words").cast("long")).withColumn("g", F.floor(F.col("h") / 10))
            .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
            .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
            .select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text")))
