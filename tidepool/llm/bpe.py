"""BPE encoding and decoding with a minimal acyclic transducer as its lexicon.

Words are counted over all texts. The frequent ones are encoded once and
compiled into a minimal acyclic automaton over their UTF-8 bytes, in which words
share beginnings and endings. Every arc has a number; along a word's path the
numbers add up to the word's place in the sorted lexicon, which is where its ids
are listed: a transducer with additive outputs. Automaton, id lists, merges and
token strings go into one file of plain arrays (a few MB, bounded by
``LEXICON``), written to the shared folder and handed to the executors with
``SparkContext.addFile``; all workers of an executor map the same pages.

Texts are then encoded in Arrow batches: words are looked up in the automaton,
all different words of some texts at a time, one byte per step. Words that it
doesn't have are merged exactly, pair by pair, lowest rank first and leftmost
among equals, through a heap, so that a word of a million letters takes
n log n steps.

The tokenizer file's settings that are supported: NFC, white space and lower
case as normalizers, a split by contractions, letters, single numbers and other
signs, byte-level symbols, an end-of-word suffix, special tokens, no decoder
(tokens are joined by spaces). ``Vocabulary`` refuses files with other settings.

Defined results: null and empty texts have no tokens and decode to the empty
string; a special token's string in a text is that token, as in the library;
texts of any length are encoded whole, in pieces that end at a space; repeated
rows and null doc_ids are encoded like any other; an empty table gives no rows;
other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import drop_written, shared_dir, table, written

TOKENIZER = "word_bpe_49k.json"  # of the installed package of public tokenizers
LEXICON = 262_144  # words of the automaton at most
PIECE = 1 << 20  # characters looked at together
HELD = 1 << 18  # chunks that a task remembers

# The split pattern of the tokenizer file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}"))
SPACES = regex.compile(r"\p{White_Space}+")
SHORT = 40  # bytes of a word up to which looking for the lowest rank each time is faster than a heap
ID_BITS = 20
NO_MERGE = 1 << 62


def byte_symbols() -> list[str]:
    """The character that stands for each byte in token strings: printable
    Latin-1 characters for themselves, the rest from U+0100 on."""
    out, spare = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


@lru_cache(maxsize=1)
def unicode_differences() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that the installed tokenizers library lower-cases otherwise
    than Python, with its result, and characters that it puts into another class
    (letter, number, space, other) than ``WORDS`` does, with a character of its
    class: the two follow different versions of Unicode."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    chars = [chr(c) for lo, hi in ((0x80, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000)) for c in range(lo, hi)]
    small = normalizers.Lowercase().normalize_str("\n".join(chars)).split("\n")
    lower = {c: x for c, x in zip(chars, small) if c.lower() != x}
    every, other = "".join(chars), {}
    for pattern, sign in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " ")):
        theirs = {c for c, _ in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every)}
        ours = set(regex.findall(pattern.replace(r"\s", r"\p{White_Space}"), every))
        other |= dict.fromkeys(theirs - ours, sign)
        other |= {c: other.get(c, "!") for c in ours - theirs}
    return lower, other


class Splitter:
    """Cuts texts into special tokens and chunks between white space, and chunks
    into words. ``special``: string to id; ``lower`` and ``other``: see
    ``unicode_differences``. Characters in these (``odd``) take a slower way."""

    def __init__(self, special: dict[str, int], lower: dict[str, str], other: dict[str, str]):
        self.special, self.lower, self.other = special, lower, other
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.small, self.signs = str.maketrans({**lower, "Σ": "σ"}), str.maketrans(other)  # no final sigma
        self.odd = {*lower, *lower.values(), *other, *"\x1c\x1d\x1e\x1f"}  # str.split takes those four for spaces
        plain = [(a, b) for a, b in (("\0", "\x1b"), (" ", "\u0557"), ("\u2000", "\u206f"), ("\u3000", "\u9fff")) if not any(a <= c <= b for c in self.odd)]
        self.unusual = re.compile("[^" + "".join(f"{re.escape(a)}-{re.escape(b)}" for a, b in plain) + "]")

    def pieces(self, text: str) -> Iterator[int | list[str]]:
        """Special tokens (an id) and, between them, lists of the chunks of about
        ``PIECE`` characters of normalized text."""
        at = 0
        for m in [*self.cut.finditer(text), None]:
            part = normalize("NFC", text[at:m.start() if m else len(text)])
            odd = self.unusual.search(part) and not self.odd.isdisjoint(part)
            part = (part.translate(self.small) if odd else part.replace("Σ", "σ")).lower()
            lo = 0
            while lo < len(part):
                hi = part.find(" ", lo + PIECE)
                hi = len(part) if hi < 0 else hi
                some = part[lo:hi]
                yield [c for c in SPACES.split(some) if c] if odd else some.split()
                lo = hi
            if m:
                yield self.special[m.group()]
                at = m.end()

    def words(self, chunk: str) -> list[str]:
        if chunk.isascii() or self.odd.isdisjoint(chunk):
            return [chunk] if chunk.isalpha() else WORDS.findall(chunk)
        return [chunk[w.start():w.end()] for w in WORDS.finditer(chunk.translate(self.signs))]


def gathered(at: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``flat[starts[i]:starts[i + 1]]`` of all i in ``at``, one after
    the other, and where each of them begins (and the last ends)."""
    begins = starts[at]
    ends = np.zeros(len(at) + 1, np.int64)
    np.cumsum(starts[at + 1] - begins, out=ends[1:])
    return flat[np.repeat(begins - ends[:-1], np.diff(ends)) + np.arange(ends[-1])], ends


class Vocabulary:
    """Merges, symbols and token strings of a tokenizer file, as arrays.

    ``pairs`` (left id * 2^20 + right id, in rank order) and ``made`` (id of the
    merged token); ``inner`` and ``last``: id of each byte inside and at the end
    of a word; ``strings``: token string of each id; ``split``: the splitter.
    """

    def __init__(self, pairs, made, inner, last, strings: list[str], split: Splitter):
        self.pairs, self.made, self.inner, self.last = pairs, made, inner, last
        self.strings, self.split = strings, split
        # a merge as one number, which sorts by rank (from 1) and names the merged token
        self.merge = {p: (r << ID_BITS) + m for r, (p, m) in enumerate(zip(pairs.tolist(), made.tolist()), 1)}
        self.starts, self.ends = inner.tolist(), last.tolist()

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            t = json.load(f)
        model, norm = t["model"], [n["type"] for n in t["normalizer"]["normalizers"]]
        split, level = t["pre_tokenizer"]["pretokenizers"]
        known = (norm == ["NFC", "Replace", "Lowercase"] and t["normalizer"]["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
                 and split["pattern"] == {"Regex": SPLIT} and split["behavior"] == "Removed" and split["invert"]
                 and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
                 and model["type"] == "BPE" and not model["dropout"] and not model["ignore_merges"] and t["decoder"] is None and len(model["vocab"]) < 1 << ID_BITS - 1
                 and not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in t["added_tokens"]))
        if not known:
            raise ValueError(f"{path}: its settings are not those that this module encodes by")
        ids, end = model["vocab"], model["end_of_word_suffix"]
        special = {a["content"]: a["id"] for a in t["added_tokens"]}
        strings = [""] * (max([*ids.values(), *special.values()]) + 1)
        for s, i in [*ids.items(), *special.items()]:
            strings[i] = s
        signs = byte_symbols()
        two = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        return cls(np.array([(ids[a] << ID_BITS) + ids[b] for a, b in two], np.int64), np.array([ids[a + b] for a, b in two], np.int32),
                   np.array([ids[s] for s in signs], np.int32), np.array([ids[s + end] for s in signs], np.int32), strings, Splitter(special, *unicode_differences()))

    def merged(self, word: bytes) -> list[int]:
        """Ids of a word: merges by rank, leftmost first among equals."""
        ids = [self.starts[b] for b in word]
        ids[-1] = self.ends[word[-1]]
        if len(ids) > SHORT:
            return self._merged_by_heap(ids)
        get = self.merge.get
        found = [get((a << ID_BITS) + b, NO_MERGE) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) < NO_MERGE:
            i = found.index(best)
            ids[i] = best & ((1 << ID_BITS) - 1)
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = get((ids[i - 1] << ID_BITS) + ids[i], NO_MERGE)
            if i < len(found):
                found[i] = get((ids[i] << ID_BITS) + ids[i + 1], NO_MERGE)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        n, merge = len(ids), self.merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := merge.get((ids[i] << ID_BITS) + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            if ids[i] < 0 or (j := after[i]) >= n or merge.get((ids[i] << ID_BITS) + ids[j]) != best:
                continue  # one of the two is merged already
            ids[i], ids[j], after[i] = best & ((1 << ID_BITS) - 1), -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (m := merge.get((ids[a] << ID_BITS) + ids[b])):
                    heapq.heappush(heap, (m, a))
        return [x for x in ids if x >= 0]

    def decoded(self, ids: Iterable[int]) -> str:
        """Token strings joined by spaces; unknown ids are left out."""
        return " ".join([self.strings[i] for i in ids if 0 <= i < len(self.strings)])


class Lexicon:
    """A minimal acyclic transducer from words (bytes) to lists of ids.

    ``arcs``: state * 256 + byte, ascending; ``to``: the arc's next state;
    ``skip``: its output; ``final``: by state; ``starts`` and ``ids``: the list
    of the word at each place.
    """

    def __init__(self, arcs, to, skip, final, starts, ids):
        self.arcs, self.to, self.skip, self.final, self.starts, self.ids = arcs, to, skip, final, starts, ids

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """Words are added in order; what lies below the beginning shared with
        the next word can't change any more and is replaced by an equal state
        where there is one (same finality, same arcs)."""
        order = sorted(words)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []

        def settled(final: bool, arcs: list) -> int:
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        path: list[list] = [[False, []]]  # states of the last word: final, arcs to settled states
        last = b""
        for word in [*order, b""]:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            for i in range(len(last), same, -1):
                state = path.pop()
                path[-1][1].append((last[i - 1], settled(*state)))
            path += [[False, []] for _ in range(len(word) - same)]
            if word:
                path[-1][0] = True
            last = word
        root = settled(*path[0])

        below = [0] * len(states)  # words that end at or below a state; arcs lead to earlier states
        arcs, to, skip = [], [], []
        for s, (final, out) in enumerate(states):
            below[s] = int(final) + sum(below[t] for _, t in out)
        number = [root, *[s for s in range(len(states)) if s != root]]  # the root is state 0
        place = {s: i for i, s in enumerate(number)}
        for s in number:
            passed = int(states[s][0])
            for b, t in states[s][1]:
                arcs.append(place[s] * 256 + b)
                to.append(place[t])
                skip.append(passed)
                passed += below[t]
        starts = np.cumsum([0, *[len(words[w]) for w in order]])
        return cls(np.array(arcs, np.int64), np.array(to, np.int32), np.array(skip, np.int32),
                   np.array([states[s][0] for s in number], bool), starts.astype(np.int64),
                   np.array([i for w in order for i in words[w]], np.int32))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 for those that the automaton doesn't have."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.arcs) or not words:
            return out
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live, state, total, j = np.flatnonzero(lengths), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        while len(live):
            key = state[live] * 256 + data[starts[live] + j]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            found = self.arcs[arc] == key
            live, arc = live[found], arc[found]
            state[live] = self.to[arc]
            total[live] += self.skip[arc]
            j += 1
            ended = lengths[live] == j
            done = live[ended]
            out[done] = np.where(self.final[state[done]], total[done], -1)
            live = live[~ended]
        return out


OF_VOCABULARY = {"pairs": np.int64, "made": np.int32, "inner": np.int32, "last": np.int32}
OF_LEXICON = {"arcs": np.int64, "to": np.int32, "skip": np.int32, "final": np.bool_, "starts": np.int64, "ids": np.int32}
ARRAYS = OF_VOCABULARY | OF_LEXICON


def packed(vocabulary: Vocabulary, lexicon: Lexicon) -> bytes:
    """The file: its header's length and header (JSON), then arrays at multiples of 64 bytes."""
    head: dict = {"strings": vocabulary.strings, "split": [vocabulary.split.special, vocabulary.split.lower, vocabulary.split.other], "arrays": {}}
    body = bytearray()
    for name, kind in ARRAYS.items():
        a = np.ascontiguousarray(getattr(vocabulary if name in OF_VOCABULARY else lexicon, name), kind)
        body += bytes(-len(body) % 64)
        head["arrays"][name] = [len(body), len(a)]
        body += a.tobytes()
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    return len(text).to_bytes(8, "little") + text + bytes(body)


@lru_cache(maxsize=2)
def mapped(path: str) -> tuple[Vocabulary, Lexicon]:
    """The file's parts; arrays are views of the mapped file."""
    with open(path, "rb") as f:
        m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    n = 8 + int.from_bytes(m[:8], "little")
    head = json.loads(m[8:n])
    a = {k: np.frombuffer(m, ARRAYS[k], length, n + at) for k, (at, length) in head["arrays"].items()}
    return (Vocabulary(*[a[k] for k in OF_VOCABULARY], head["strings"], Splitter(*head["split"])), Lexicon(*[a[k] for k in OF_LEXICON]))


class Encoder:
    """Encodes texts through the lexicon; words that it hasn't are merged. The
    ids of up to ``HELD`` chunks are remembered from text to text."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self._forget()

    def _forget(self) -> None:
        self.held: dict[str, int] = {}
        self.letters, self.flat, self.starts = 0, np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.ids_of: dict[str, bytes] = {}
        self.said_of: dict[str, str] = {}
        self.said = 0

    def _remember(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.held]
        if len(self.held) + len(new) > HELD or self.letters > 64 * HELD:
            self._forget()
            new = list(chunks)
        if new:
            flat, starts = self.lists(new)
            self.held.update(zip(new, range(len(self.held), len(self.held) + len(new))))
            self.letters += sum(map(len, new))
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.flat)])
            self.flat = np.concatenate([self.flat, flat])

    def lists(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after the other, and where each chunk's begin."""
        words: dict[str, int] = {}  # every different word and its place among them
        of_chunk, ends = [], [0]
        for c in chunks:
            of_chunk += [words.setdefault(w, len(words)) for w in self.vocabulary.split.words(c)]
            ends.append(len(of_chunk))
        raw = [w.encode() for w in words]
        places, lexicon, new = self.lexicon.places(raw), self.lexicon, []
        begins = np.zeros((len(raw) + 1), np.int64)
        lengths = np.where(places >= 0, lexicon.starts[places + 1] - lexicon.starts[places], 0)
        for i in np.flatnonzero(places < 0).tolist():
            new.append(self.vocabulary.merged(raw[i]))
            lengths[i] = len(new[-1])
        np.cumsum(lengths, out=begins[1:])
        known = np.repeat(places >= 0, lengths)
        ids = np.empty(begins[-1], np.uint32)
        ids[known] = gathered(places[places >= 0], lexicon.starts, lexicon.ids)[0]
        ids[~known] = np.fromiter((x for part in new for x in part), np.uint32, int((~known).sum()))
        flat, at = gathered(np.array(of_chunk, np.int64), begins, ids)
        return flat, at[np.array(ends)]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: number of ids, SHA-256 of the ids and of the decoded text."""
        of_ids, of_text, n = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts], [0] * len(texts)
        for some in self._together(texts):
            self._tell(set().union(*[p for _, p in some if not isinstance(p, int)]))
            for i, piece in some:
                if isinstance(piece, int):
                    ids, said = piece.to_bytes(4, "little"), " " + self.vocabulary.strings[piece]
                else:
                    ids, said = b"".join(map(self.ids_of.__getitem__, piece)), "".join(map(self.said_of.__getitem__, piece))
                of_ids[i].update(ids)
                of_text[i].update((said if n[i] else said[1:]).encode())
                n[i] += len(ids) >> 2
        return [(k, x.hexdigest(), y.hexdigest()) for k, x, y in zip(n, of_ids, of_text)]

    def _tell(self, chunks: set[str]) -> None:
        """Remember ids, as bytes, and token strings, a space before each, of new chunks."""
        new = list(chunks.difference(self.ids_of))
        if len(self.ids_of) + len(new) > HELD or self.said > 64 * HELD:
            self._forget()
            new = list(chunks)
        if new:
            flat, starts = self.lists(new)
            raw, at = flat.astype("<u4").tobytes(), starts.tolist()
            strings = [" " + self.vocabulary.strings[i] for i in flat.tolist()]
            self.said += sum(map(len, new))
            for c, lo, hi in zip(new, at, at[1:]):
                self.ids_of[c], self.said_of[c] = raw[4 * lo:4 * hi], "".join(strings[lo:hi])

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(place of a text, ids of a stretch of it), in order; a long one comes in several runs."""
        for some in self._together(texts):
            yield from self._runs(some)

    def _together(self, texts: list[str]) -> Iterator[list[tuple[int, int | list]]]:
        """(place of a text, piece of it), in order, until there are ``PIECE / 4`` chunks."""
        some: list[tuple[int, int | list]] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in self.vocabulary.split.pieces(text):
                some.append((i, piece))
                size += 1 if isinstance(piece, int) else 1 + len(piece)
                if size >= PIECE // 4:
                    yield some
                    some, size = [], 0
        yield some

    def _runs(self, some: list) -> Iterator[tuple[int, np.ndarray]]:
        self._remember(set().union(*[p for _, p in some if not isinstance(p, int)]))
        for i, piece in some:
            if isinstance(piece, int):
                yield i, np.array([piece], np.uint32)
            else:
                yield i, gathered(np.fromiter(map(self.held.__getitem__, piece), np.int64, len(piece)), self.starts, self.flat)[0]


def count_words(split: Splitter, docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; counted per task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told():
            words: Counter = Counter()
            for chunk, n in held.items():
                for w in split.words(chunk):
                    words[w] += n
            return pa.record_batch([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for text in b.column(0).to_pylist():
                for piece in split.pieces(text):
                    if not isinstance(piece, int):
                        held.update(piece)
                        if len(held) > 200_000:
                            yield told()
                            held.clear()
        yield told()

    words = docs.where("text IS NOT NULL").select("text").mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, at most ``most`` and none of a count's
    words without the others in its band (an eighth of a doubling)."""
    banded = counts.where("octet_length(word) <= 64").withColumn("band", F.floor(F.log2("n") * 8).cast("int"))
    bands = banded.groupBy("band").agg(F.count("*").alias("words")).collect()  # one row a band: at most 512
    total, least = 0, None
    for r in sorted(bands, key=lambda r: -r.band):
        total += r.words
        if total > most:
            break
        least = r.band
    return banded.where(F.lit(False) if least is None else F.col("band") >= least).select("word")


def write_file(spark: SparkSession, path: str, data: bytes) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(data)
    finally:
        out.close()


def compile_lexicon(spark: SparkSession, docs: DataFrame, vocabulary: Vocabulary, most: int = LEXICON) -> str:
    """Count, choose, encode and compile the frequent words of ``docs``; the name
    under which every executor finds the file among the Spark files."""
    counts = written(spark, count_words(vocabulary.split, docs), "words")
    words = {r.word.encode(): vocabulary.merged(r.word.encode()) for r in frequent(counts, most).collect()}
    drop_written(spark, counts)
    name = f"lexicon-{uuid.uuid4().hex[:16]}.bin"
    path = f"{shared_dir(spark)}/llm/{name}"
    write_file(spark, path, packed(vocabulary, Lexicon.build(words)))
    spark.sparkContext.addFile(path)
    return name


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, most: int = LEXICON) -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded."""
    name = compile_lexicon(spark, docs, Vocabulary.read(tokenizer), most)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, vocabulary in _encoded(name, batches):
            flat = [[t for run in runs for t in run.tolist()] for runs in ids]
            yield pa.record_batch([part, pa.array(flat, pa.list_(pa.int32())), pa.array(map(vocabulary.decoded, flat), pa.string())],
                                  names=["doc_id", "ids", "decoded"])

    return _texts(docs).mapInArrow(encode, "doc_id long, ids array<int>, decoded string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _encoded(name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[list[np.ndarray]], Vocabulary]]:
    """doc_ids, ids in runs and the vocabulary, for some texts at a time."""
    vocabulary, lexicon = mapped(SparkFiles.get(name))
    encoder = Encoder(vocabulary, lexicon)
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            ids: list[list[np.ndarray]] = [[] for _ in range(part.num_rows)]
            for i, run in encoder.encode(part.column(1).to_pylist()):
                ids[i].append(run)
            yield part.column(0), ids, vocabulary


def decode_documents(spark: SparkSession, coded: DataFrame, tokenizer: str) -> DataFrame:
    """One row per row of ``coded`` (doc_id, ids): doc_id, decoded."""
    strings = Vocabulary.read(tokenizer).decoded

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [strings(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(said, pa.string())], names=["doc_id", "decoded"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decode, "doc_id long, decoded string")


def digests(spark: SparkSession, docs: DataFrame, tokenizer: str, most: int = LEXICON) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Ids and
    decoded text are hashed where they are made."""
    name = compile_lexicon(spark, docs, Vocabulary.read(tokenizer), most)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*mapped(SparkFiles.get(name)))
        for part in (b.slice(lo, 256) for b in batches for lo in range(0, b.num_rows, 256)):
            n, a, t = zip(*encoder.digests(part.column(1).to_pylist()))
            yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(t)],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
