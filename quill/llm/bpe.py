"""Byte-level BPE as a streaming transducer with bounded lookahead, and back.

``lookahead`` computes from the merge list how many bytes beyond a boundary can
still change what lies before it. An encoder therefore holds a window of a few
thousand bytes whatever the length of a text or of a single pre-token (a
100,000-letter word is one): it emits a token once it ends further than that
from the last byte seen. Pre-tokens are cut by the vocabulary's pattern over
chunks, again with a bounded margin. Decoding is an incremental state machine
from token bytes to text that holds at most three bytes between tokens.

Ids equal those of the tokenizers library with ``add_special_tokens=False``:
the special token spelled out in a text is that token.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow

VOCABULARY = "byte_bpe_50k"
CHUNK = 1 << 16        # characters cut into pre-tokens at once
WINDOW = 16            # an open pre-token is encoded per this many lookaheads
MEMO = 1 << 18         # short pre-tokens remembered per task, twice
SHORT = 64             # bytes of a pre-token that may be remembered
PART = 1 << 16         # token ids per row of ``encode``
NEVER, TOKEN = 1 << 62, (1 << 32) - 1     # no such merge; the token in a merge's value
#: fixed values: the vocabulary's pre-token pattern over classes of characters
#: (letters L, numbers N, white space S, others O), and the runs it is made of
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
RUNS = {"L": "[L]*", "N": "[N]*", "O": "[^SLN]*", "S": "[S]*"}
#: the longest way a match of PATTERN looks beyond its end
MARGIN = 2
#: blocks whose characters every Unicode version since 6.0 puts into the same class
BLOCKS = [(0x00, 0x557), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20B5), (0x3041, 0x3096), (0x30A0, 0x30FF),
          (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF9E)]
SETTLED = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in BLOCKS) + "]*")
#: one settled character per class, in no contraction
STANDS_FOR = {"L": "ª", "N": "²", "O": "§", "S": " "}


def class_ranges() -> dict[str, str]:
    """The settled letters, numbers and white space as ranges of a character class."""
    out = {"L": [], "N": [], "S": []}
    for a, b in BLOCKS:
        text = "".join(map(chr, range(a, b + 1)))
        for kind, one in (("L", r"\p{L}+"), ("N", r"\p{N}+"), ("S", r"\s+")):
            out[kind] += [f"{re.escape(m[0])}-{re.escape(m[-1])}" for m in regex.findall(one, text)]
    return {kind: "".join(parts) for kind, parts in out.items()}


def over_classes(pattern: str, ranges: dict[str, str]) -> re.Pattern:
    """``pattern`` with the class names in its brackets spelled out."""
    return re.compile(re.sub(r"\[(\^?)([LNS]+)\]",
                             lambda m: f"[{m[1]}{''.join(ranges[k] for k in m[2])}]", pattern))


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable
    Latin-1 characters for themselves, the other bytes from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def lookahead(merges: list[tuple[str, str]]) -> int:
    """Bytes beyond which text cannot change a token any more.

    Run the merges in order of rank over two texts that agree up to byte ``i``;
    let ``d <= i`` be the boundary up to which their tokens agree so far. Only a
    merge (x, y) across ``d`` moves it, to the left by ``len(x)``. The next such
    merge (x', y') has a higher rank, and its right side starts with that x:
    either y' is x, or x went into y' by a merge not below the first one's rank.
    The longest such chain bounds ``i - d``. It is found from the last rank down,
    one pass over the left spines of all right sides.
    """
    made = {a + b: r for r, (a, b) in enumerate(merges)}
    if len(made) < len(merges) or any(made.get(s, -1) >= r for r, ab in enumerate(merges) for s in ab):
        raise ValueError("not a proper merge list: a part must be made before it is used, and once")
    opens: list[list] = [[] for _ in merges]
    reach: dict[str, int] = {}
    top = 0
    for r in range(len(merges) - 1, -1, -1):
        for start, far in opens[r]:
            reach[start] = max(reach.get(start, 0), far)
        x, y = merges[r]
        far = len(x) + reach.get(x, 0)
        top = max(top, far)
        reach[y] = max(reach.get(y, 0), far)
        while y in made:
            used = made[y]
            y = merges[used][0]
            opens[used].append((y, far))
    return top


class Vocabulary:
    """Tables of one vocabulary file; made inside a task."""

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers as files

        with open(files.path(f"{name}.json"), encoding="utf-8") as f:
            spec = json.load(f)
        self.file = files.path(f"{name}.json")
        byte = byte_letters()
        ids = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        # rank above, new token below: the smallest value is the merge to do next
        self.merge = {(ids[a], ids[b]): r << 32 | ids[a + b] for r, (a, b) in enumerate(merges)}
        self.first = [0] * 256
        for letter, b in byte.items():
            self.first[b] = ids[letter]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes[i] = bytes(map(byte.__getitem__, token))
        for token, i in self.special.items():
            self.bytes[i] = token.encode("utf-8")
        self.far = lookahead(merges)

    def ids(self, raw: bytes) -> list[int]:
        """Token ids of one whole pre-token or window."""
        ids = list(map(self.first.__getitem__, raw))
        return self._long(ids) if len(ids) > SHORT else self._brief(ids)

    def _brief(self, ids: list[int]) -> list[int]:
        get = self.merge.get
        found = list(map(get, zip(ids, islice(ids, 1, None)), repeat(NEVER)))
        while found:
            best = min(found)
            if best == NEVER:
                break
            at = found.index(best)
            ids[at] = best & TOKEN
            del ids[at + 1], found[at]
            # only the pairs beside the new token have changed
            if at:
                found[at - 1] = get((ids[at - 1], ids[at]), NEVER)
            if at < len(found):
                found[at] = get((ids[at], ids[at + 1]), NEVER)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same by a heap of (rank, place) over a linked list."""
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        get = self.merge.get
        heap = [(m, k, ids[k], ids[k + 1]) for k in range(n - 1) if (m := get((ids[k], ids[k + 1]), NEVER)) < NEVER]
        heapq.heapify(heap)
        while heap:
            m, k, a, b = heapq.heappop(heap)
            j = right[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], ids[j] = m & TOKEN, -1
            right[k] = right[j]
            if right[j] < n:
                left[right[j]] = k
            for u, v in ((left[k], k), (k, right[k])):
                if u >= 0 and v < n and (m := get((ids[u], ids[v]), NEVER)) < NEVER:
                    heapq.heappush(heap, (m, u, ids[u], ids[v]))
        return [t for t in ids if t >= 0]


class Classes:
    """Characters outside ``SETTLED`` as the tokenizers library classes them: its
    Unicode tables decide, asked once per character."""

    def __init__(self, file: str):
        self.file, self.ask, self.known = file, None, {}

    def __missing(self, c: str) -> str:
        if self.ask is None:
            from tokenizers import Tokenizer
            self.ask = Tokenizer.from_file(self.file).pre_tokenizer
        for kind, before in (("L", "a"), ("N", "1"), ("O", "!")):
            if len(self.ask.pre_tokenize_str(before + c)) == 1:
                return STANDS_FOR[kind]
        return STANDS_FOR["S"]

    def plain(self, text: str) -> str:
        """``text``, each unsettled character replaced by one of its class."""
        if SETTLED.fullmatch(text):
            return text
        for c in set(text) - self.known.keys():
            self.known[c] = c if SETTLED.fullmatch(c) else self.__missing(c)
        return text.translate({ord(c): to for c in set(text) if (to := self.known[c]) != c})


class _Memo(dict):
    """Short pre-token -> its ids as little-endian bytes. Two generations of at most
    ``MEMO`` words: when the young one is full it becomes the old one, and words
    met again move back, so frequent words stay whatever passes by."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.old = vocabulary, {}

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            raw = word.encode("utf-8")
            if len(raw) > SHORT:
                run = OpenWord(self.vocabulary)
                return run.feed(raw) + run.close()
            out = pack(self.vocabulary.ids(raw))
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = out
        return out


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class OpenWord:
    """One pre-token of any length: bytes in, stable ids out."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, b""

    def feed(self, raw: bytes) -> bytes:
        v, out = self.vocabulary, []
        room = WINDOW * v.far
        for at in range(0, len(raw), room):
            self.held += raw[at:at + room]
            if len(self.held) < room:
                break
            end = 0
            for t in v.ids(self.held):
                if end + len(v.bytes[t]) > len(self.held) - v.far:
                    break
                end += len(v.bytes[t])
                out.append(t)
            self.held = self.held[end:]
        return pack(out)

    def close(self) -> bytes:
        raw, self.held = self.held, b""
        return pack(self.vocabulary.ids(raw))


class Encoder:
    """Chunks of a text in, ids (little-endian unsigned 32-bit) out."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.memo = _Memo(vocabulary)
        self.classes = Classes(vocabulary.file)
        ranges = class_ranges()
        self.words = over_classes(PATTERN, ranges)
        self.runs = {k: over_classes(p, ranges) for k, p in RUNS.items()}
        self.marks = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None
        self.mark_room = max(map(len, vocabulary.special), default=1) - 1

    def encode(self, chunks: Iterable[str]) -> Iterator[bytes]:
        """Ids of the chunks' concatenation, emitted once they are stable."""
        segment = Segment(self)
        held = ""
        for chunk in chunks:
            held += chunk
            if self.marks:
                at = 0
                for m in self.marks.finditer(held):
                    yield segment.feed(held[at:m.start()], last=True)
                    yield pack([self.vocabulary.special[m.group()]])
                    segment, at = Segment(self), m.end()
                held = held[at:]
            # what may be the beginning of a special token waits for the next chunk
            keep = min(self.mark_room, len(held))
            while keep and not any(s.startswith(held[len(held) - keep:]) for s in self.vocabulary.special):
                keep -= 1
            yield segment.feed(held[:len(held) - keep], last=False)
            held = held[len(held) - keep:]
        yield segment.feed(held, last=True)

    def text(self, text: str | None) -> Iterator[bytes]:
        text = text or ""
        if len(text) <= CHUNK and not (self.marks and self.marks.search(text)):
            yield Segment(self).feed(text, last=True)
        else:
            yield from self.encode(text[k:k + CHUNK] for k in range(0, len(text), CHUNK))


class Segment:
    """Text between special tokens. State: an unfinished tail of at most a chunk,
    or an open pre-token's class and its window."""

    def __init__(self, encoder: Encoder):
        self.e, self.held, self.kind, self.open = encoder, "", None, None

    def feed(self, text: str, last: bool) -> bytes:
        out = []
        text = self.held + text
        self.held = ""
        if self.open is not None:
            text = self._continue(text, last, out)
        if self.open is None and text:
            plain = self.e.classes.plain(text)
            words = self.e.words.findall(plain)
            rest = 0
            if not last:
                while words and rest < MARGIN:
                    rest += len(words.pop())
            end = len(text) - rest
            if plain is not text:
                cuts = np.cumsum([0, *map(len, words)]).tolist()
                words = [text[a:b] for a, b in zip(cuts, cuts[1:])]
            out.append(b"".join(map(self.e.memo.__getitem__, words)))
            self.held = text[end:]
            if len(self.held) >= CHUNK // 2:
                self._begin(out)
        return b"".join(out)

    def _begin(self, out: list):
        """The tail is a pre-token that goes on: to the window, but for the last
        character. If it is finished after all, it waits one more chunk."""
        plain = self.e.classes.plain(self.held)
        if len(self.e.words.match(plain).group()) < len(plain):
            return
        kind = next(k for k, run in self.e.runs.items() if run.fullmatch(plain[-1]))
        self.kind, self.open = kind, OpenWord(self.e.vocabulary)
        out.append(self.open.feed(self.held[:-1].encode("utf-8")))
        self.held = self.held[-1:]

    def _continue(self, text: str, last: bool, out: list) -> str:
        """Feeds the open pre-token; returns what follows it. The last white space
        of a run belongs to what follows the run, so it is always held back."""
        end = self.e.runs[self.kind].match(self.e.classes.plain(text)).end()
        goes_on = end == len(text) and not last
        if goes_on or (self.kind == "S" and end < len(text)):
            end = max(end - 1, 0)
        out.append(self.open.feed(text[:end].encode("utf-8")))
        if goes_on:
            self.held = text[end:]
            return ""
        out.append(self.open.close())
        self.kind = self.open = None
        return text[end:]


class Decoder:
    """Token ids in, text out as soon as its bytes are whole. Bytes that are no
    UTF-8 become U+FFFD, one per longest broken sequence."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int], last: bool = False) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)), last)


def _digests(vocabulary: str):
    def run(batches):
        v = Vocabulary(vocabulary)
        encoder = Encoder(v)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1):
                count, ids_hash, text_hash, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(v.bytes)
                for part in encoder.text(text.as_py()):
                    count += len(part) // 4
                    ids_hash.update(part)
                    text_hash.update(decoder.feed(np.frombuffer(part, "<u4").tolist()).encode("utf-8"))
                text_hash.update(decoder.feed([], last=True).encode("utf-8"))
                n.append(count)
                ids_sha.append(ids_hash.hexdigest())
                text_sha.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                                              pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.

    Ids are hashed as they become stable and decoded at once, so neither a
    text's ids nor its decoded form is ever held whole. A null or empty text has
    no token (digests of nothing); very long texts and pre-tokens stream; a null
    id keeps its row; repeated rows and ties give equal rows; an empty table
    gives none. Other columns are ignored, whatever their names.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow(src, _digests(vocabulary), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _parts(vocabulary: str, room: int):
    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["doc_id", "part", "ids"])

    def run(batches):
        encoder = Encoder(Vocabulary(vocabulary))
        for b in batches:
            rows, size = [], 0
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                part, held = 0, b""
                for more in encoder.text(text.as_py()):
                    held += more
                    while len(held) > 4 * room:
                        rows.append((i, part, np.frombuffer(held[:4 * room], "<u4").astype(np.int32)))
                        held, part, size = held[4 * room:], part + 1, size + room
                        if size > 4 * room:
                            yield batch(rows)
                            rows, size = [], 0
                rows.append((i, part, np.frombuffer(held, "<u4").astype(np.int32)))
                size += len(held) // 4
                if size > 4 * room:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY, part_ids: int = PART) -> DataFrame:
    """``(doc_id, part, ids)``: the token ids of each text in rows of at most
    ``part_ids`` ids, numbered from 0; an empty or null text has one empty part."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow(src, _parts(vocabulary, part_ids), "doc_id long, part int, ids array<int>")


def _texts(vocabulary: str):
    def run(batches):
        table = Vocabulary(vocabulary).bytes
        last, decoder = object(), None
        for b in batches:
            out = []
            for i, part, ids, end in zip(*(b.column(k).to_pylist() for k in range(4))):
                if i != last or part == 0:
                    last, decoder = i, Decoder(table)
                out.append(decoder.feed(ids or [], last=end))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())],
                                             ["doc_id", "part", "text"])
    return run


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``tokens(doc_id, part, ids)``, one document per id -> ``(doc_id, part,
    text)``; a document's texts, joined by part, are its decoded text. Parts of
    one document pass one state machine in order; bytes of a character that
    spans two parts come out with the later one."""
    last = F.col("part") == F.max("part").over(_whole())
    rows = (tokens.select("doc_id", "part", "ids").withColumn("end", last)
            .sortWithinPartitions("doc_id", "part").select("doc_id", "part", "ids", "end"))
    return arrow(rows, _texts(vocabulary), "doc_id long, part int, text string")


def _whole():
    from pyspark.sql import Window
    return Window.partitionBy("doc_id")
