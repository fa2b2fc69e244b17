"""BPE encoding and decoding (operator 8).

Method: bounded-lookahead streaming transducer.  From the merge list follows
how far to the left an unread symbol can still change the tokens of what was
read (``lookahead``); tokens further left are stable and are emitted, so a word
of any length is encoded in a window of constant size, in time linear in its length.
Decoding feeds the bytes of the emitted tokens to an incremental byte-to-text state
machine.

The vocabulary is a ``tokenizers`` JSON file with a BPE model, its path a
parameter; the driver reads it and broadcasts its text (a file of a few MB,
whatever the corpus).  The tokenizer is not trained or changed here.

Defined cases: a null text is the empty text, which has no tokens; repeated
rows are encoded alike; texts are encoded whole; an empty table gives an empty
result; other columns are not looked at.  Letters and digits are those of the
Python's Unicode tables.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.llm.common import ship, table

#: Chunks between white space whose tokens a worker remembers; then it starts anew.
CACHE = 250_000
#: Rows, and characters of texts, that a worker encodes at a time.
ROWS_OUT, CHARS_OUT = 512, 4_000_000
#: No rule; and what marks a special token among chunks.
NONE, MARK = np.int32(2**31 - 1), " "
#: Tokens that the decoder is fed at a time.
FEED = 1 << 16
#: Characters of a long text that are worked on at a time.
SLICE = 1 << 20
#: Bytes up to which words are merged many at a time; longer ones are streamed.
SHORT = 48
#: What the vocabulary's normalizer and splitter take for white space, where
#: str.split() would take more.
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACES = "\t-\r \x85\xa0  -     　"
SPACE = re.compile(f"[{SPACES}]+")


def ranges(category: str) -> str:
    """The characters of a Unicode category, as ranges of a regex class."""
    hits = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == category]
    out, start = [], None
    for c, after in zip(hits, [*hits[1:], None]):
        start = c if start is None else start
        if after != c + 1:
            out.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return "".join(out)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: Latin-1 letters and signs for themselves, the rest from
    U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    keeps = set(own)
    return [chr(b) if b in keeps else chr(next(rest)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]]) -> int | None:
    """How many symbols before the end of what was read can still change.

    Text that follows changes the tokens at the boundary.  A rule (u, v) carries
    a change to the left, by u, only when v starts where the change does; then
    the next rule to carry it comes later in the list, and its v starts with
    this u.  The bound is the longest such chain, found in one pass over the
    rules.  None if some token is made by two rules or before its parts are:
    then a merge can enable an earlier one and no bound follows.
    """
    made: set[str] = set()
    size = lambda t: len(t.removesuffix("</w>"))
    for u, v in merges:
        if u + v in made or any(size(x) > 1 and x not in made for x in (u, v)):
            return None
        made.add(u + v)
    best: dict[str, int] = {}
    most = 1
    for u, v in merges:
        reach = size(u) + max((best.get(v[:k], 0) for k in range(1, len(v) + 1)), default=0)
        if reach > best.get(u, 0):
            best[u] = reach
        most = max(most, reach)
    return most


class Vocabulary:
    """A BPE vocabulary with its normalizer and splitter."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rules = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b])
                      for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.ahead = lookahead(merges)
        letters = byte_alphabet()
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        self.inner = [self.ids[c] for c in letters]
        self.final = [self.ids[c + self.suffix] for c in letters]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for name, body in ((r"\p{L}", ranges("L")), (r"\p{N}", ranges("N")), (r"\s", SPACES)):
            split = split.replace(name, body)
        self.pieces = re.compile(split)
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.raw = {i: t.encode() for i, t in self.tokens.items()}
        self.cache: dict[str, bytes] = {}
        self._index()

    def _index(self) -> None:
        """The rules as a hash table that numpy can probe for many pairs at once."""
        pairs = np.array(list(self.rules), dtype=np.int64).reshape(-1, 2)
        keys = self._key(pairs[:, 0], pairs[:, 1])
        self.made = np.array([i for _, i in self.rules.values()], dtype=np.int32)
        self.slots = np.full(1 << 20, -1, dtype=np.int64)
        self.ranks = np.full(1 << 20, NONE, dtype=np.int32)
        self.probes = 1
        for rank, key in enumerate(keys.tolist()):
            at, n = self._slot(key), 1
            while self.slots[at] >= 0:
                at, n = (at + 1) & 0xFFFFF, n + 1
            self.slots[at], self.ranks[at], self.probes = key, rank, max(self.probes, n)
        self.inner_of = np.array(self.inner, dtype=np.int32)
        self.final_of = np.array(self.final, dtype=np.int32)

    @staticmethod
    def _key(a, b):
        return (a.astype(np.int64) << 20) | b

    @staticmethod
    def _slot(key):
        return (key * 0x9E3779B1 >> 13) & 0xFFFFF

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the rule for each pair of tokens; NONE where there is none."""
        key = self._key(a, b)
        at = self._slot(key)
        out = np.where(self.slots[at] == key, self.ranks[at], NONE)
        for _ in range(self.probes - 1):
            open_ = np.flatnonzero((out == NONE) & (self.slots[at] >= 0) & (self.slots[at] != key))
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & 0xFFFFF
            hit = open_[self.slots[at[open_]] == key[open_]]
            out[hit] = self.ranks[at[hit]]
        return out

    def merge(self, ids: list[int]) -> list[int]:
        """Applies the rules to symbols: lowest rank first, leftmost of those.

        The symbols are a linked list, the rules that apply a heap; an entry whose
        pair has changed since is passed over.
        """
        rules, ids, n = self.rules, list(ids), len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rules[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rules]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            rule = rules.get((ids[i], ids[j])) if ids[i] >= 0 and j < n else None
            if rule is None or rule[0] != rank:
                continue
            ids[i], ids[j], after[i] = rule[1], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (new := rules.get((ids[k], ids[after[k]]))):
                    heappush(heap, (new[0], k))
        return [t for t in ids if t >= 0]

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` for many short words side by side: words that fit one window
        are encoded in one step of the transducer."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for lo in range(0, len(order), 4096):
            rows = np.array(order[lo:lo + 4096])
            group = [words[i] for i in rows]
            sizes = np.array([len(w) for w in group])
            wide = int(sizes[-1])
            flat = np.frombuffer(b"".join([w.ljust(wide, b"\0") for w in group]), np.uint8)
            grid = self.inner_of[flat.reshape(-1, wide)]
            last = np.arange(len(group)), sizes - 1
            grid[last] = self.final_of[flat.reshape(-1, wide)[last]]
            rank = np.full((len(group), max(wide - 1, 1)), NONE, dtype=np.int32)
            if wide > 1:
                real = np.arange(1, wide) < sizes[:, None]
                rank[real] = self.rank(grid[:, :-1][real], grid[:, 1:][real])
            self._merge_grid(rows, grid, rank, sizes, out)
        return out

    def _merge_grid(self, rows, grid, rank, sizes, out) -> None:
        while len(rows):
            at = rank.argmin(1)
            low = rank[np.arange(len(rows)), at]
            live = low < NONE
            if not live.all():
                done = np.flatnonzero(~live)
                for r, tokens, n in zip(rows[done].tolist(), grid[done].tolist(),
                                        sizes[done].tolist()):
                    out[r] = tokens[:n]
                keep = np.flatnonzero(live)
                rows, grid, rank, sizes, at, low = (
                    x[keep] for x in (rows, grid, rank, sizes, at, low))
                if not len(rows):
                    return
            n, wide = grid.shape
            every, spots = np.arange(n), np.arange(wide)
            grid[every, at] = self.made[low]
            gone = np.minimum(spots + (spots > at[:, None]), wide - 1)
            grid = np.take_along_axis(grid, gone, 1)
            rank = np.take_along_axis(
                np.concatenate([rank, np.full((n, 1), NONE, np.int32)], 1),
                spots[:-1] + (spots[:-1] >= at[:, None]), 1)
            sizes = sizes - 1
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.rank(grid[left, at[left] - 1], grid[left, at[left]])
            right = np.flatnonzero(at < sizes - 1)
            rank[right, at[right]] = self.rank(grid[right, at[right]], grid[right, at[right] + 1])

    def stream(self, word: Iterable[int]) -> Iterator[list[int]]:
        """Tokens of one word, given as bytes, as they become stable.

        Keeps a window of a few lookaheads; the last byte of a word takes the
        end-of-word form, so one byte is always held back.
        """
        window = 4 * self.ahead if self.ahead else None
        held: list[int] = []
        for b in word:
            held.append(b)
            if window and len(held) > window:
                tokens = self.merge([self.inner[x] for x in held[:-1]])
                done, out = 0, []
                for t in tokens:
                    n = len(self.tokens[t])
                    if done + n > len(held) - 1 - self.ahead:
                        break
                    done += n
                    out.append(t)
                yield out
                held = held[done:]
        if held:
            yield self.merge([*(self.inner[x] for x in held[:-1]), self.final[held[-1]]])

    def learn(self, chunks: Iterable[str]) -> None:
        """Encodes chunks (normalized texts without white space) into the cache."""
        chunks = list(chunks)
        pieces = [[p.encode() for p in self.pieces.findall(c)] for c in chunks]
        short = list({p for ps in pieces for p in ps if len(p) <= SHORT})
        known = dict(zip(short, self.merge_many(short)))
        for chunk, ps in zip(chunks, pieces):
            ids = array("I")
            for p in ps:
                if len(p) <= SHORT:
                    ids.extend(known[p])
                else:
                    for tokens in self.stream(p):
                        ids.extend(tokens)
            self.cache[chunk] = ids.tobytes()

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian unsigned 32-bit integers, and
        the text that the decoder makes of these."""
        split = []
        for text in texts:
            parts = self.marks.split(text) if "<|" in text else [text]
            split.append([c for part in parts for c in (
                [MARK + part] if part in self.special else
                [w for piece in slices(part) for w in words(piece) if w])])
        used = {c for chunks in split for c in chunks if c[0] != MARK}
        new = [c for c in used if c not in self.cache]
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = used
        if new:
            self.learn(new)
        for mark, i in self.special.items():
            self.cache.setdefault(MARK + mark, array("I", [i]).tobytes())
        for chunks in split:
            ids = b"".join(map(self.cache.__getitem__, chunks))
            yield ids, Decoder(self, joined=True).decode(ids)


def slices(text: str) -> Iterator[str]:
    """Cuts of a long text before blanks, so that neither composition nor words
    cross a cut."""
    at = 0
    while len(text) - at > SLICE:
        cut = max(text.rfind(" ", at + 1, at + SLICE), text.rfind("\n", at + 1, at + SLICE))
        if cut < 0:
            after = [x for x in (text.find(" ", at + SLICE), text.find("\n", at + SLICE)) if x > 0]
            cut = min(after, default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def words(text: str) -> list[str]:
    """The normalized text (composed, lower case), cut at white space."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # str.lower() has a final form; the vocabulary has one form
            text = text.replace("Σ", "σ")
    text = text.lower()
    return text.split() if not NOT_SPACE.search(text) else SPACE.split(text)


class Decoder:
    """Tokens to text, a few at a time.

    ``joined``: as a vocabulary without a decoder does it, the tokens' own
    strings with a blank between.  Otherwise the bytes that the tokens stand
    for go through a state machine that holds an unfinished character back;
    the end of a word becomes a blank.
    """

    def __init__(self, vocabulary: Vocabulary, joined: bool):
        self.v, self.joined, self.begun = vocabulary, joined, False
        self.text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if self.joined:
            raw = list(filter(None, map(self.v.raw.get, ids)))
            glue = b" " if self.begun and raw else b""
            self.begun = self.begun or bool(raw)
            return self.text.decode(glue + b" ".join(raw))
        out = []
        for i in ids:
            token = self.v.tokens.get(i)
            if token is None:
                continue
            if token in self.v.special:
                raw = token.encode()
            else:
                end = self.v.suffix and token.endswith(self.v.suffix)
                body = token.removesuffix(self.v.suffix) if end else token
                raw = bytes(self.v.bytes_of[c] for c in body) + (b" " if end else b"")
            out.append(self.text.decode(raw))
        return "".join(out)

    def finish(self) -> str:
        return self.text.decode(b"", True)

    def decode(self, ids: bytes) -> str:
        """All of a text, ``FEED`` tokens at a time."""
        step = 4 * FEED
        return "".join([self.feed(memoryview(ids)[at:at + step].cast("I"))
                        for at in range(0, len(ids), step)]) + self.finish()


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch (second column: texts) in parts of bounded rows and characters."""
    at = size = 0
    for i, n in enumerate(pc.utf8_length(batch.column(1)).to_pylist()):
        if i > at and (i - at >= ROWS_OUT or size + n > CHARS_OUT):
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if batch.num_rows > at:
        yield batch.slice(at)


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(text: str) -> Vocabulary:
    """One per worker process."""
    key = hash(text)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(text)
    return _LOADED[key]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) as doc_id, ids (binary: little-endian
    unsigned 32-bit integers) and decoded (text)."""
    spark = docs.sparkSession
    ship(spark)
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        vocabulary = _vocabulary(spec.value)
        for batch in batches:
            for part in parts_of(batch):
                done = list(vocabulary.encode(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([d[0] for d in done], pa.binary()),
                     pa.array([d[1] for d in done], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def decode(tokens: DataFrame, path: str, joined: bool = True) -> DataFrame:
    """Rows of ``tokens`` (doc_id, ids) as doc_id and text."""
    spark = tokens.sparkSession
    ship(spark)
    with open(path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part, texts = batch.slice(at, ROWS_OUT), []
                for raw in part.column(1).to_pylist():
                    texts.append("" if raw is None else Decoder(vocabulary, joined).decode(raw))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def default_path() -> str:
    """The vocabulary of the contract, where the installed package has it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe(spark, sf_dir, path: str | None = None):
    """Token count and digests of ids and decoded text of every document."""
    out = encode(table(spark, sf_dir, "documents"), path or default_path())
    return out.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
