"""Texts that were decoded with the wrong character encoding (problem 8).

Model. A text is a row of segments (sentences, lines). Each segment has a latent *encoding chain*: none, or one or more
steps "written as w, read as r". Given the chain, the stored characters determine the written ones, so the likelihood of
a segment under a chain is the probability of the repaired characters under a character bigram model of clean text. The
chain's prior depends on the record's source and field, and prior and model are fitted by expectation-maximization:

* start   bigram counts over all texts as stored;
* E-step  posterior of every chain of every segment;
* M-step  prior of a chain = its posterior share among all segments of the source and field (weak evidence is pooled);
          bigram counts = stored counts, with the expected share of each garbled island replaced by its repaired form.

The prior is refitted until the likelihood stands still, the bigram model until the expected number of garbled segments
does. At last each record is decided by posterior: a segment is repaired by its best chain where garbled outweighs clean;
a chain that is certain in one segment of a text counts as likely in that text's other segments.

Cost. Only *islands* matter for the evidence: stretches without white space around characters beyond ASCII. Texts are cut
into segments of islands once; each *distinct* segment is judged once per model, however many texts hold it; priors and
decisions are joins of these tables. Only texts that are repaired are read again.

Bounds. Characters are counted exactly (there are 1,114,112), pairs in a count-min table of two rows of 2^21 counters: all
texts count, nothing is dropped, and the model has one size whatever the corpus. An island may be arbitrary with
probability e^-12, which bounds what one island can say for or against a chain. A chain goes on for as long as undoing
UTF-8 changes something, which shortens the text and thus ends. U+FFFD stands for bytes that are lost; it counts as an
unknown character, is never learned as clean text, and stays in the repaired text.
"""

from __future__ import annotations

import codecs
import functools
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litholake.llm.tokens import CHUNK_BYTES, chunks, text_buffer
from litholake.session import discard, materialise, spread

#: Encodings of one byte a character, of several bytes, as they are read or written in error.
SINGLE = ("cp1252", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "cp437", "cp850", "cp852", "cp866", "koi8_r", "mac_roman", "iso8859_2", "iso8859_5", "iso8859_15")
MULTI = ("gb18030", "cp932", "euc_jp", "big5", "euc_kr")
LOST = "�"
LOST_LOG = -4.5  # log probability of an unknown character
SMOOTH, FLOOR = 2.0, 0.1
WORST = -12.0  # an island may be arbitrary with this log probability
START, PSEUDO, STRENGTH = 1e-4, 0.5, 20.0  # prior of a chain before any evidence; segments it is granted; weight of all sources in a source's prior, in segments
BEHIND = 40.0  # a chain that far behind a segment's best has a posterior below 1e-5 whatever the priors (above e^-28)
PAIR_ROWS, PAIR_BITS = 2, 21
_HASH = np.array([[0x9E3779B97F4A7C15], [0xD6E8FEB86659FD93]], np.uint64)


def _byte_chars(name: str) -> str:
    """What each byte is read as; a byte without meaning is read as the control character of its number."""
    return "".join(_one(b, name) for b in range(256))


def _one(b: int, name: str) -> str:
    try:
        return bytes([b]).decode(name)
    except UnicodeDecodeError:
        return chr(b)


READ = {r: _byte_chars(r) for r in SINGLE}
#: Stored character -> character numbered by its byte. Unread characters below U+0100 go out of the way.
UNREAD = {r: {i: 0x100 for i in range(0x80, 0x100)} | {i: i for i in range(0x80, 0xA0)} | {ord(c): b for b, c in enumerate(READ[r]) if b >= 0x80} for r in SINGLE}
CHARS = {r: set(READ[r][0x80:]) | {chr(i) for i in range(0x80, 0xA0)} for r in SINGLE}
#: Characters that a reader makes of the first and of the following bytes of a UTF-8 sequence.
LEADS = {r: {READ[r][b] for b in range(0xC2, 0xF5)} for r in SINGLE}
FOLLOWS = {r: {READ[r][b] for b in range(0x80, 0xC0)} | {chr(i) for i in range(0x80, 0xA0)} | {"\ufffd"} for r in SINGLE}
_CONT = "[\x80-\xbf�]"
UTF8 = re.compile(f"[\xc2-\xdf]{_CONT}|[\xe0-\xef]{_CONT}{{2}}|[\xf0-\xf4]{_CONT}{{3}}")
#: All patterns here take time in proportion to the text, whatever it looks like.
BORDER = re.compile(r"(?<=[.!?。！？]) |[。！？]|[\n\r]+")
NUMBER = re.compile(r"[0-9][0-9.,]+")
ISLAND = re.compile(r"[^\t\n\r ]?[^\x00-\x7f](?:[^\t\n\r ]*[^\x00-\x7f])?[^\t\n\r ]?")
LATIN = re.compile(r"[0-9A-Za-z_.,-]+")
_W = "\u2e80-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
WIDE = re.compile(f"[{_W}]")
STRETCH = re.compile(f"[{_W}][{_W}\ufffd]*|[^{_W}]+")
codecs.register_error("litholake_lost", lambda e: (b"\xff", e.end))

STEPS = (
    [(r, "utf_8") for r in (*SINGLE, *MULTI)]
    + [(r, w) for w in SINGLE for r in SINGLE if r != w]
    + [(r, w) for w in MULTI for r in (*SINGLE, *MULTI) if r != w]
)
LOST_STEP = ("utf_8", "lost")
BY_READER: dict[str, list[tuple[str, str]]] = {}
for _s in STEPS:
    BY_READER.setdefault(_s[0], []).append(_s)


def _utf8_match(m: re.Match) -> str:
    s = m[0]
    if LOST in s:
        return LOST
    try:
        return s.encode("latin-1").decode("utf_8")
    except UnicodeDecodeError:
        return s


def stored_as(text: str, reader: str) -> str | bytes | None:
    """A text as its reader had it before: one character for each byte (single-byte readers), or its bytes; None where it
    can't have come from this reader."""
    if reader in UNREAD:
        return text.translate(UNREAD[reader])
    if not any("\u2e80" <= c for c in text):  # text read as an East Asian encoding holds wide characters
        return None
    try:
        return text.encode(reader, "litholake_lost" if LOST in text else "strict")  # lost bytes stay lost, no others
    except UnicodeError:
        return None


def undo(text: str, step: tuple[str, str], seen: str | bytes | None = None) -> str | None:
    """``text`` with one step undone; None where the step can't have happened or changes nothing. ``seen``: what
    ``stored_as`` gives, if known."""
    r, w = step
    if w == "lost":
        return text if LOST in text else None
    seen = stored_as(text, r) if seen is None else seen
    if seen is None:
        return None
    if w == "utf_8" and r in UNREAD:  # sequence by sequence, so that text beside garbled sequences stays
        parts, at = [], 0
        for m in UTF8.finditer(seen):
            fixed = _utf8_match(m)
            if fixed != m[0]:
                parts += [text[at : m.start()], fixed]
                at = m.end()
        return "".join([*parts, text[at:]]) if parts else None
    try:
        if r in UNREAD:
            out = seen.translate(_WRITE[w]) if w in READ and seen.isascii() is False and max(seen) < "\u0100" else None if w in READ else seen.encode("latin-1").decode(w)
        elif LOST in text:
            out = seen.decode(w, "replace")
            if out.count(LOST) > 2 * text.count(LOST):
                return None
        else:
            out = seen.decode(w)
    except UnicodeError:
        return None
    return None if out == text else out


_WRITE = {w: {b: READ[w][b] for b in range(0x80, 0x100)} for w in SINGLE}


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def pair_cells(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The counter of a pair in each row of the count-min table."""
    x = (a.astype(np.uint64) << np.uint64(21)) | b.astype(np.uint64)
    with np.errstate(over="ignore"):
        return ((x[None, :] * _HASH) >> np.uint64(64 - PAIR_BITS)).astype(np.int64) + (np.arange(PAIR_ROWS)[:, None] << PAIR_BITS)


class Counts:
    """Counters of characters and pairs; linear, so parts are added up and repaired text replaces stored text."""

    def __init__(self) -> None:
        self.one = np.zeros(0x110000)
        self.pair = np.zeros(PAIR_ROWS << PAIR_BITS)

    def add(self, cp: np.ndarray, first: np.ndarray | None = None, weight: float = 1.0) -> None:
        """Counts characters and pairs; no pair over the border before a ``first`` character, none with U+FFFD."""
        ok = cp != ord(LOST)
        np.add.at(self.one, cp[ok], weight)
        both = ok[1:] & ok[:-1]
        if first is not None:
            both &= ~first[1:]
        np.add.at(self.pair, pair_cells(cp[:-1][both], cp[1:][both]).ravel(), weight)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``k`` (pairs from 0 on, characters below) and ``n`` of the counters that aren't 0."""
        one, pair = np.flatnonzero(self.one), np.flatnonzero(self.pair)
        k, n = np.concatenate([-1 - one, pair]), np.concatenate([self.one[one], self.pair[pair]])
        for a in range(0, len(k), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(k[a : a + (1 << 16)]), pa.array(n[a : a + (1 << 16)])], names=["k", "n"])


class Bigrams:
    """Character bigram model with back-off to single characters."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self._load()

    def _load(self) -> None:
        self.one, self.pair = np.zeros(0x110000), np.zeros(PAIR_ROWS << PAIR_BITS)
        single = self.keys < 0
        self.one[-1 - self.keys[single]] = np.maximum(self.counts[single], 0.0)
        self.pair[self.keys[~single]] = np.maximum(self.counts[~single], 0.0)
        self.total = float(self.one.sum())

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "counts": self.counts}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._load()

    def logs(self, texts: Sequence[str], lost: float | None = None) -> np.ndarray:
        """Log probability of all characters but the first of each text (none empty). ``lost``: that of an unknown one."""
        n = self.total + 20000.0
        lost = math.log(FLOOR / n) if lost is None else lost
        cp = code_points("".join(texts))
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        a, b = cp[:-1], cp[1:]
        u = (self.one[b] + FLOOR) / n
        both = self.pair[pair_cells(a, b)].min(axis=0)
        p = np.where(a == ord(LOST), u, (both + SMOOTH * u) / (np.maximum(self.one[a], both) + SMOOTH))
        value = np.concatenate([[0.0], np.where(b == ord(LOST), lost, np.log(p))])
        value[starts[:-1]] = 0.0
        return np.add.reduceat(value, starts[:-1]) if len(texts) else np.zeros(0)


def readings(text: str) -> Iterator[tuple[tuple[str, str], str]]:
    """Every single step that is possible for a text, with what was written under it."""
    beyond = {c for c in text if c > "\x7f"}
    if all(c.isspace() or c in "\ufeff\u200b" for c in beyond):  # odd spaces alone tell nothing
        return
    wide = any("\u2e80" <= c for c in beyond)
    for reader, steps in BY_READER.items():
        single = reader in UNREAD
        whole = beyond <= CHARS[reader] if single else wide
        sequences = not (beyond.isdisjoint(LEADS[reader]) or beyond.isdisjoint(FOLLOWS[reader])) if single else wide
        seen = stored_as(text, reader) if whole or sequences else None
        if seen is None:
            continue
        for step in steps:
            if (sequences if step[1] == "utf_8" else whole) and (fixed := undo(text, step, seen)):
                yield step, fixed


def score_islands(islands: Sequence[str], model: Bigrams) -> list[dict[tuple, float]]:
    """For each island the log likelihood ratio of each of its chains against "not garbled".

    Steps are undone level by level, until nothing changes. Undoing UTF-8 shortens a text; of the results that do, those of
    one step repeated are followed, and the likeliest of the level, under the first chain that leads to it. One island says at most ``WORST``
    against a chain. That is the default for chains that aren't possible or not listed; only of piecewise chains, whose
    default is 0, such low ratios are listed."""
    out: list[dict[tuple, float]] = [{} for _ in islands]
    if not len(islands):
        return out
    base = model.logs(islands)
    lost = [k for k, t in enumerate(islands) if LOST in t]
    if lost:
        for k, v in zip(lost, model.logs([islands[k] for k in lost], LOST_LOG) - base[lost], strict=True):
            out[k][LOST_STEP,] = float(v)
    front = [(k, t, [()]) for k, t in enumerate(islands)]
    seen: list[set[str]] = [{t} for t in islands]
    while front:
        found: dict[tuple[int, str], tuple[int, list[tuple], list[tuple]]] = {}
        for k, text, chains in front:
            for step, fixed in readings(text):
                _, every, follow = found.setdefault((k, fixed), (len(text), [], []))
                more = [(*c, step) for c in chains]
                every += more
                if step[1] == "utf_8":
                    follow += more
        got = model.logs([t for _, t in found], LOST_LOG) if found else np.zeros(0)
        front, best = [], {}
        for ((k, fixed), (size, every, follow)), v in zip(found.items(), got.tolist(), strict=True):
            ratio = v - base[k]
            mine = out[k]
            for chain in every:
                if ratio > WORST or _piecewise(chain):
                    mine[chain] = max(mine.get(chain, WORST), ratio)
            if follow and len(fixed) < size and not fixed.isascii() and fixed not in seen[k]:
                seen[k].add(fixed)
                front.append((k, fixed, follow))
                best[k] = max(best.get(k, (v, fixed)), (v, fixed))
        same = [[c for c in f if len(set(c)) == 1] for _, _, f in front]
        front = [(k, t, [*f[:1], *s[f[0] in s :]] if best[k][1] == t else s) for (k, t, f), s in zip(front, same, strict=True)]
        front = [f for f in front if f[2]]
    return out


@functools.cache
def _piecewise(chain: tuple) -> bool:
    return all(w == "lost" or (w == "utf_8" and r in UNREAD) for r, w in chain)


def islands_of(segment: str) -> list[str]:
    """Islands with one character of context on either side. Numbers are no evidence and are shortened, and so are Latin
    names within East Asian writing, which makes islands recur."""
    out = []
    for word in ISLAND.findall(segment):
        s = NUMBER.sub("0", word)
        if WIDE.search(s):
            s = LATIN.sub("0", s)
        out.append((s if s[0].isascii() else " " + s) + ("" if s[-1].isascii() else " "))
    return out


def segments_of(text: str) -> list[str]:
    """Sentences and lines; where wide (East Asian) writing meets other characters beyond ASCII, each is a segment of its
    own, since a sentence garbled by a single-byte reading may follow a clean one without any space."""
    out = []
    ends = [m.end() for m in BORDER.finditer(text)]
    for s in [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True) if a < b]:
        if s.isascii() or not WIDE.search(s):
            out.append(s)
            continue
        held = ""
        for part in STRETCH.findall(s):
            if part.isascii() or WIDE.match(part) or part.replace(LOST, "").isascii():
                held += part
            else:
                out += [held, part] if held else [part]
                held = ""
        if held:
            out.append(held)
    return out


def count_borders(text: str) -> int:
    """Number of sentences and lines: that of ``segments_of`` for a text without East Asian writing, which isn't cut."""
    n = end = 0
    for m in BORDER.finditer(text):
        n, end = n + 1, m.end()
    return n + (end < len(text))


def name_of(chain: tuple) -> str:
    return "+".join(f"{w}<{r}" for r, w in chain)


def chain_of(name: str) -> tuple:
    return tuple((r, w) for w, r in (p.split("<") for p in name.split("+")))


def repair_segment(segment: str, chain: tuple) -> str:
    """The segment with all steps of the chain undone, word by word where a step is not possible as a whole."""
    for step in chain:
        whole = undo(segment, step)
        if whole is not None and (LOST not in whole or step[1] == "utf_8" and step[0] in UNREAD):
            segment = whole
        else:
            segment = re.sub(r"[^\t\n\r ]+", lambda m, s=step: m[0] if m[0].isascii() else undo(m[0], s) or m[0], segment)
    return segment


# --- Spark ----------------------------------------------------------------------------------------------------------


def normal_source(c: Column) -> Column:
    return F.translate(F.lower(F.trim(F.coalesce(c, F.lit("")))), "-", "_")


ROW = ["doc_id", "field", "mark"]
CUT = "doc_id long, field string, mark long, key string, n long, segs array<struct<no: int, islands: array<string>>>"


def cut_texts(docs: DataFrame) -> DataFrame:
    """Of each text the number of its segments, and the islands of those that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, many, no, size, islands = [], [0], [], [0], []
            for text in b.column(4).to_pylist():
                if text.isascii():
                    n.append(count_borders(text))
                else:
                    parts = segments_of(text)
                    n.append(len(parts))
                    for k, s in enumerate(parts):
                        if not s.isascii():
                            islands += islands_of(s)
                            no.append(k)
                            size.append(len(islands))
                many.append(len(no))
            held = pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(islands, pa.string()))
            segs = pa.ListArray.from_arrays(pa.array(many, pa.int32()), pa.StructArray.from_arrays([pa.array(no, pa.int32()), held], names=["no", "islands"]))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(n, pa.int64()), segs], names=["doc_id", "field", "mark", "key", "n", "segs"])

    return docs.select(*ROW, "key", "text").mapInArrow(run, CUT)


def count_pairs(texts: DataFrame, text_col: str) -> DataFrame:
    """Counters of characters and pairs over all texts: ``k long, n double``, of bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counts()
        for b in batches:
            buf, offsets = text_buffer(b.column(0))
            for i, j in chunks(offsets, CHUNK_BYTES):
                part = buf[offsets[i] : offsets[j]]
                if not len(part):
                    continue
                cp = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
                lead = np.flatnonzero((part & 0xC0) != 0x80)
                first = np.zeros(len(cp) + 1, bool)
                first[np.searchsorted(lead, offsets[i:j] - offsets[i])] = True
                c.add(cp, first[: len(cp)])
        yield from c.rows()

    return texts.select(text_col).filter(F.col(text_col) != "").mapInArrow(run, "k long, n double").groupBy("k").agg(F.sum("n").alias("n"))


def fit_model(counts: DataFrame) -> Bigrams:
    """The model of all counters that aren't 0: at most 5.3 million rows, whatever the corpus."""
    top = counts.filter("n > 0").toPandas()
    return Bigrams(top["k"].to_numpy(np.int64), top["n"].to_numpy(float))


SEG = ["h1", "h2"]
CACHE = 100_000


def segments(cut: DataFrame) -> DataFrame:
    """The segments that hold islands, with two 64-bit hashes of these that stand for them."""
    seg = cut.select(*ROW, "key", F.explode("segs").alias("s")).select(*ROW, "key", "s.no", "s.islands")
    return seg.withColumns({"h1": F.xxhash64("islands"), "h2": F.xxhash64(F.lit("second"), "islands")})


def combine(scores: list[dict[tuple, float]]) -> list[tuple[str, float]]:
    """The chains of a segment whose ratio, the sum of its islands', is above 0 and not hopelessly behind the best.

    Steps that undo sequence by sequence leave other islands as they are; any other chain must be possible throughout. A
    sum above 0 takes an island that is."""
    sums = {}
    for chain in {c for s in scores for c, v in s.items() if v > 0}:
        gap = 0.0 if _piecewise(chain) else WORST
        total = sum(s.get(chain, gap) for s in scores)
        if total > 0:
            sums[chain] = total
    best = max(sums.values(), default=0.0)
    return sorted((name_of(c), round(v, 1)) for c, v in sums.items() if v > best - BEHIND)


def evidence(segs: DataFrame, model: Broadcast) -> DataFrame:
    """``h1, h2, c`` (chains and log likelihood ratios) of the distinct segments that may be garbled. A task keeps the
    scores of the islands it has seen, as most recur; what is kept is bounded and only saves work."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, dict[tuple, float]] = {}
        target = pa.list_(pa.struct([("chain", pa.string()), ("ratio", pa.float64())]))
        for b in batches:
            for a in range(0, b.num_rows, 512):
                part = b.slice(a, 512)
                lists = part.column(2).to_pylist()
                new = sorted({i for x in lists for i in x} - cache.keys())
                if len(cache) + len(new) > CACHE:
                    cache.clear()
                    new = sorted({i for x in lists for i in x})
                for k in range(0, len(new), 256):
                    cache.update(zip(new[k : k + 256], score_islands(new[k : k + 256], model.value), strict=True))
                found = [combine([cache[i] for i in x]) for x in lists]
                keep = [k for k, c in enumerate(found) if c]
                rows = part.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([[{"chain": n, "ratio": v} for n, v in found[k]] for k in keep], target)], names=[*SEG, "c"])

    return segs.select(*SEG, "islands").mapInArrow(run, "h1 long, h2 long, c array<struct<chain: string, ratio: double>>")


def weighed(found: DataFrame, odds: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """``found`` with ``share``, the posterior of each chain among those of the same ``by`` columns (what is missing to 1
    is the share of "not garbled"), and ``ll``, their log weight against "not garbled". ``odds``: prior by key and chain."""
    if odds is None:
        p = found.withColumn("odds", F.lit(math.log(START)))
    else:
        p = found.join(odds, ["key", "chain"], "left").withColumn("odds", F.coalesce("odds", F.lit(math.log(START))))
    return _softmax(p, F.col("ratio") + F.col("odds"), by)


def _softmax(p: DataFrame, value: Column, by: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*by)
    p = p.withColumn("v", value).withColumn("top", F.greatest(F.lit(0.0), F.max("v").over(w)))
    p = p.withColumn("total", F.exp(-F.col("top")) + F.sum(F.exp(F.col("v") - F.col("top"))).over(w))
    return p.withColumns({"share": F.exp(F.col("v") - F.col("top")) / F.col("total"), "ll": F.col("top") + F.log("total")}).drop("v", "top", "total")


def fit_prior(held: DataFrame, sizes: DataFrame, odds: DataFrame | None = None, tolerance: float = 5e-4, most: int = 200) -> tuple[DataFrame, float]:
    """The prior (``key, chain, odds``: log odds) by EM over the evidence (``key, c, n``), until the log likelihood changes by less than
    ``tolerance`` of itself; and the expected number of garbled segments. ``odds``: a prior to start from. Raises after ``most`` rounds (the likelihood
    rises in each, so it settles far before).

    Segments with the same evidence are counted first, so a round costs little. A source's shares are smoothed towards
    those of all sources with the weight of ``STRENGTH`` segments. Sources are rows of a table, as many as there are."""
    kinds = materialise(held.groupBy("key", "c").agg(F.sum("n").alias("n")).withColumn("kind", F.monotonically_increasing_id()), "kinds")  # numbered once, when written
    flat = kinds.select("kind", "key", "n", F.posexplode("c").alias("at", "e")).select("kind", "key", "n", "at", "e.chain", "e.ratio")
    everything = float(sizes.agg(F.sum("n")).first()[0] or 1.0)
    shares, last = None, None
    for _ in range(most):
        got = weighed(flat, odds, ["kind"]).groupBy("key", "chain").agg(F.sum(F.col("share") * F.col("n")).alias("w"), F.sum(F.when(F.col("at") == 0, F.col("ll") * F.col("n"))).alias("ll"))
        before, shares = shares, materialise(got, "shares")
        discard(before)
        many, ll = (float(v or 0.0) for v in shares.agg(F.sum("w"), F.sum("ll")).first())
        overall = shares.groupBy("chain").agg(((F.sum("w") + PSEUDO) / (everything + 50)).alias("p"))
        odds = shares.join(overall, "chain").join(sizes, "key").select("key", "chain", F.log((F.col("w") + STRENGTH * F.col("p")) / (F.col("n") + STRENGTH)).alias("odds"))
        if last is not None and abs(ll - last) <= tolerance * max(abs(ll), 1.0):
            discard(kinds)
            return odds, many
        last = ll
    raise RuntimeError(f"the prior did not settle in {most} rounds")


def repaired_counts(held: DataFrame, segs: DataFrame, odds: DataFrame) -> DataFrame:
    """Expected change of the counts: stored islands of garbled segments out, repaired ones in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for b in batches:
            for island, name, w in zip(*(c.to_pylist() for c in b.columns), strict=True):
                counts.add(code_points(island), None, -w)
                counts.add(code_points(repair_segment(island, chain_of(name))), None, w)
        yield from counts.rows()

    flat = held.select("key", *SEG, "n", F.explode("c").alias("e")).select("key", *SEG, "n", "e.chain", "e.ratio")
    share = weighed(flat, odds, ["key", *SEG]).groupBy(*SEG, "chain").agg(F.sum(F.col("share") * F.col("n")).alias("w")).filter("w > 0.001")
    moved = share.join(segs, SEG).select(F.explode("islands").alias("island"), "chain", "w").groupBy("island", "chain").agg(F.sum("w").alias("w"))
    return moved.mapInArrow(run, "k long, n double")


def decide(found: DataFrame, odds: DataFrame) -> DataFrame:
    """``doc_id, field, mark, picks`` (segment number and chain) of the garbled texts, from the evidence (segments with
    ``key`` and ``c``) alone. Repeated rows count once."""
    seg = [*ROW, "no"]
    row = found.dropDuplicates(seg).select(*seg, "key", F.explode("c").alias("e")).select(*seg, "key", "e.chain", "e.ratio").repartition(*ROW)
    first = weighed(row, odds, seg).withColumn("sure", F.max("share").over(Window.partitionBy(*ROW, "chain")))
    local = F.greatest(F.col("odds"), F.when(F.col("sure") > 0.9, F.lit(math.log(0.5))).otherwise(F.lit(-1e9)))
    again = _softmax(first.drop("share", "ll"), F.col("ratio") + local, seg)
    best = again.groupBy(*seg).agg(F.sum("share").alias("garbled"), F.max(F.struct("share", "chain")).alias("best")).filter("garbled > 0.5")
    return best.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("no", F.col("best.chain").alias("chain")))).alias("picks"))


def repair(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The judged texts, repaired."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            used, fixed = [], []
            for text, picks in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                parts = segments_of(text)
                for p in picks:
                    parts[p["no"]] = repair_segment(parts[p["no"]], chain_of(p["chain"]))
                used.append(list(dict.fromkeys(p["chain"] for p in picks)))
                fixed.append("".join(parts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(used, pa.list_(pa.string())), pa.array(fixed, pa.string()), pa.array([LOST not in f for f in fixed], pa.bool_())], names=["doc_id", "field", "chains", "repaired", "complete"])

    return docs.join(judged, ROW).select("doc_id", "field", "text", "picks").mapInArrow(run, "doc_id long, field string, chains array<string>, repaired string, complete boolean")


def _texts(df: DataFrame, id_col: str, text_cols: Sequence[str], source_col: str) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in text_cols])).alias("t")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), normal_source(F.col(source_col)).alias("source"), each).select("doc_id", "source", "t.field", "t.text")
    rows = rows.filter("doc_id is not null and text is not null and text <> ''")
    return spread(rows).select("doc_id", "field", F.xxhash64("text").alias("mark"), F.concat_ws("\u0001", "field", "source").alias("key"), "text")


def judge_texts(df: DataFrame, id_col: str = "doc_id", text_cols: Sequence[str] = ("text",), source_col: str = "source", settled: float = 0.01, most: int = 20) -> DataFrame:
    """Which texts were read with another encoding than they were written in: ``doc_id``, ``field``, ``mark`` (hash of the
    text) and ``picks``, the chain of each garbled segment.

    Null, empty and ASCII texts are never garbled; rows without id take no part. Null and uneven sources are normalised.
    Whole texts are judged, however long. Rows that repeat id and text count once. The model is refitted until the
    expected number of garbled segments changes by less than ``settled`` of itself, in at most ``most`` rounds."""
    spark: SparkSession = df.sparkSession
    docs = _texts(df, id_col, text_cols, source_col)
    cut = materialise(cut_texts(docs), "cut")
    counts = materialise(count_pairs(docs, "text"), "pairs")
    segs = segments(cut).select(*SEG, "islands").distinct()
    segs = materialise(segs.repartitionByRange(spark.sparkContext.defaultParallelism, "islands"), "segments")  # segments that begin alike share their islands
    kinds = materialise(segments(cut).groupBy("key", *SEG).agg(F.count("*").alias("n")), "kinds")
    sizes = materialise(cut.groupBy("key").agg(F.sum("n").alias("n")), "sizes")
    now, before, odds, ev, held = counts, None, None, None, None
    for _ in range(most):
        model = spark.sparkContext.broadcast(fit_model(now))
        discard(ev)
        discard(held)
        ev = materialise(evidence(segs, model), "evidence")
        held = materialise(kinds.join(ev, SEG), "held")
        odds, many = fit_prior(held, sizes, odds)
        if before is not None and abs(many - before) <= settled * max(many, 1.0):
            break
        before = many
        now = counts.unionByName(repaired_counts(held, segs, odds)).groupBy("k").agg(F.sum("n").alias("n"))
    return decide(segments(cut).drop("islands").join(ev, SEG), odds)


def find_garbled(df: DataFrame, id_col: str = "doc_id", text_cols: Sequence[str] = ("text",), source_col: str = "source") -> DataFrame:
    """The texts that ``judge_texts`` finds, and what was written.

    ``doc_id``, ``field``, ``chains`` (names ``written<read`` of the steps undone, last reading first), ``repaired``, and
    ``complete`` (false where characters are lost, which stay U+FFFD). Repeated rows come out as often as they come in."""
    return repair(_texts(df, id_col, text_cols, source_col), judge_texts(df, id_col, text_cols, source_col))
