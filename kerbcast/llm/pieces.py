"""SentencePiece encoding and decoding that keeps every piece's place in the source bytes.

A text is normalised by longest-prefix matches in the model's compiled character map; each
normalised character remembers the source bytes it came from.  Pieces are then merged by
score, and each is projected to the byte span of its characters.  No piece of a usable
model holds a blank mark after another character, so texts are cut before blank marks (and
around line feeds, where no longer piece has them) and each distinct cut is encoded once
per task; where a model has such pieces, the text is encoded in one go.  A long text goes
in stretches that part where two characters stand together in no piece, so that beside its
ids and spans a task holds little for it (a model with a character map of its own takes it
in one go).  The model is read on the driver; tasks need its rules alone, no library.

Results for odd rows: a null text counts as empty and has no ids and an empty decoded text;
texts of any length are encoded whole; repeated rows give repeated results; an empty table
gives an empty table; other columns are carried along only where named in ``keep``.
"""

from __future__ import annotations

import heapq
import hashlib
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kerbcast.llm.bytetext import slices
from kerbcast.llm.common import ship

BLANK = "▁"
#: Distinct cuts, and characters and ids of cuts, remembered by a process before it starts
#: afresh, new cuts encoded at a time, bytes of text handled at once, characters of a long
#: text's stretch, ids decoded at a time: they bound its memory only.
REMEMBERED, HELD, LEARNT, SLICE, STRETCH, RUN = 200_000, 8 << 20, 4096, 256 << 10, 256 << 10, 256 << 10
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8 and the replacements."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]
        self.known: dict[str, tuple[str, int]] = {}

    def longest(self, source: bytes, begin: int) -> tuple[bytes, int] | None:
        """The replacement and length of the longest key that starts at ``begin``."""
        if not self.units:
            return None
        node, found = 0, None
        unit = self.units[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for place in range(begin, len(source)):
            node ^= source[place]
            unit = self.units[node]
            if unit & 0x800000FF != source[place]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                at = self.units[node] & 0x7FFFFFFF
                found = at, place + 1 - begin
        if found is None:
            return None
        at, length = found
        return self.replacements[at : self.replacements.index(b"\0", at)], length


class Pieces:
    """A model's vocabulary and rules, read from its serialized form."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE:
            raise ValueError("only models with merge scores are supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("blank marks must come before words")
        if any(p.type in (USER, UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.name = hashlib.sha256(model).hexdigest()
        rules = proto.normalizer_spec
        self.prefix, self.squeeze, self.mark = (
            rules.add_dummy_prefix,
            rules.remove_extra_whitespaces,
            BLANK if rules.escape_whitespaces else " ",
        )
        self.map = CharacterMap(rules.precompiled_charsmap)
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        if len(self.bytes) != 256:
            raise ValueError("a model without all byte pieces is not supported")
        self.surface = [p.piece if p.type == NORMAL else "" for p in proto.pieces]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        longer = [p for p in self.ids if len(p) > 1]
        self.joined = {p[k : k + 2] for p in longer for k in range(len(p) - 1)}
        self.plain = not self.map.units and self.prefix and not self.squeeze and self.mark == BLANK
        if any(BLANK in p.lstrip(BLANK) for p in longer):
            self.cuts = re.compile(r".+", re.S)
        elif any("\n" in p for p in longer):
            self.cuts = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        else:
            self.cuts = re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")

    def stretches(self, text: str) -> Iterator[str]:
        """The text in runs of STRETCH characters or a few more: no merge goes across where
        one ends, as no piece holds the two characters there side by side."""
        begin, n = 0, len(text)
        while begin < n:
            end = begin + STRETCH if self.plain else n
            while end < n and text[end - 1 : end + 1].replace(" ", BLANK) in self.joined:
                end += 1
            yield text[begin:end]
            begin = end

    def normalize(self, text: str, inside: bool = False) -> tuple[str, list[int]]:
        """The normalised text and, for each of its characters and its end, the source
        byte at which that character's bytes begin.  ``inside``: text stands before it."""
        source = text.encode()
        out: list[str] = []
        places: list[int] = []
        at = 0
        last_blank = self.squeeze
        if self.prefix and source and not inside:
            out.append(self.mark)
            places.append(0)
        while at < len(source):
            found = self.map.longest(source, at)
            if found is None:
                lead = source[at]
                length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                piece = source[at : at + length].decode()
            else:
                piece, length = found[0].decode(), found[1]
            if last_blank:
                piece = piece.lstrip(" ")
            for character in piece:
                out.append(self.mark if character == " " else character)
                places.append(at)
            if piece:
                last_blank = self.squeeze and piece.endswith(" ")
            at += length
        if self.squeeze:
            while out and out[-1] == self.mark:
                at = places.pop()
                out.pop()
        return "".join(out), [*places, at]

    def merge(self, cut: str) -> list[str]:
        """The cut's pieces: again and again the best-scored neighbours become one, the
        leftmost first."""
        get, none = self.scores.get, -math.inf
        parts = list(cut)
        if len(parts) > 48:
            return self._merge_long(parts)
        merged = [get(left + right, none) for left, right in zip(parts, parts[1:], strict=False)]
        while merged and (best := max(merged)) > none:
            i = merged.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del merged[i]
            if i:
                merged[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(merged):
                merged[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        scores, n = self.scores, len(parts)
        after = list(range(1, n)) + [-1]
        before = list(range(-1, n - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right >= 0 and (score := scores.get(whole := parts[left] + parts[right])) is not None:
                heapq.heappush(queue, (-score, left, right, whole))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, left, right, whole = heapq.heappop(queue)
            if not parts[left] or after[left] != right or parts[left] + parts[right] != whole:
                continue
            parts[left], parts[right] = whole, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [p for p in parts if p]

    def encode_cut(self, cut: str) -> list[int]:
        ids: list[int] = []
        for part in self.merge(cut):
            i = self.ids.get(part)
            ids += [self.bytes[b] for b in part.encode()] if i is None else [i]
        return ids

    def characters(self, ids: list[int]) -> list[int]:
        """Normalised characters that each id completes; a byte piece completes one when
        it is the last byte of that character."""
        held, left = [], 0
        for i in ids:
            if (b := self.byte_of.get(i)) is None:
                held.append(len(self.surface[i]))
                continue
            left = left - 1 if left else (b >= 0xC0) + (b >= 0xE0) + (b >= 0xF0)
            held.append(int(left == 0))
        return held

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, runs of byte pieces read as UTF-8 (a byte that
        fits nowhere becomes U+FFFD), blank marks turned to spaces, the mark added before
        the text taken off."""
        out: list[str] = []
        raw = bytearray()
        for i in [*ids, self.unknown]:
            if (b := self.byte_of.get(i)) is not None:
                raw.append(b)
                continue
            out += [_utf8(bytes(raw)), self.surface[i].replace(BLANK, " ")]
            raw.clear()
        return self.trimmed("".join(out))

    def trimmed(self, text: str) -> str:
        """The text without the mark that stood before it."""
        if not self.prefix or not text:
            return text
        return text.lstrip(" ") if self.squeeze else text[text[0] == " " :]


def _utf8(raw: bytes) -> str:
    out = []
    while raw:
        try:
            return "".join([*out, raw.decode()])
        except UnicodeDecodeError as bad:
            out += [raw[: bad.start].decode(), "\ufffd"]
            raw = raw[bad.start + 1 :]
    return "".join(out)


class Merges:
    """All merges of a vocabulary as one open-addressed table, to merge many cuts at once."""

    SLOTS, NEVER, STRANGE = 1 << 21, np.int32(2**31 - 1), 1 << 30

    def __init__(self, pieces: Pieces) -> None:
        order = {s: r for r, s in enumerate(sorted(set(pieces.scores.values()), reverse=True))}
        self.rank = np.full(len(pieces.surface), self.NEVER, np.int32)
        self.symbol = np.arange(0x110000, dtype=np.int64) + self.STRANGE
        pairs = {}
        for piece, i in pieces.ids.items():
            self.rank[i] = order[pieces.scores[piece]]
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = pieces.ids.get(piece[:k]), pieces.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << 31 | right] = i
        self.keys = np.full(self.SLOTS, -1, np.int64)
        self.merged = np.zeros(self.SLOTS, np.int32)
        self.probes = 1
        for key, i in pairs.items():
            at, n = int(self._slot(np.array([key]))[0]), 1
            while self.keys[at] >= 0:
                at, n = (at + 1) % self.SLOTS, n + 1
            self.keys[at], self.merged[at], self.probes = key, i, max(self.probes, n)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(43)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, id) of the pairs' merges; a pair without one has rank NEVER."""
        keys = left << 31 | right
        keys[(left >= self.STRANGE) | (right >= self.STRANGE)] = -2
        slots = self._slot(keys)
        merged = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for _ in range(self.probes):
            held = self.keys[slots]
            hit = held == keys[open_]
            merged[open_[hit]] = self.merged[slots[hit]]
            more = ~hit & (held >= 0)
            open_, slots = open_[more], (slots[more] + 1) % self.SLOTS
            if not len(open_):
                break
        return np.where(merged >= 0, self.rank[merged], self.NEVER), merged

    def apply(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows of symbols, padded with STRANGE, after every merge; one merge of each row
        at a time, best rank first, then leftmost."""
        rows, width = symbols.shape
        ranks = np.full((rows, width), self.NEVER, np.int32)
        ids = np.zeros((rows, width), np.int64)
        for k in range(width - 1):
            own = np.flatnonzero(counts > k + 1)
            ranks[own, k], ids[own, k] = self.look(symbols[own, k], symbols[own, k + 1])
        done = symbols.copy()
        live = np.arange(rows)
        span = np.arange(width)
        while len(live):
            at = ranks.argmin(1)
            going = ranks[np.arange(len(at)), at] < self.NEVER
            done[live[~going]] = symbols[~going]
            live, at = live[going], at[going]
            symbols, ranks, ids = symbols[going], ranks[going], ids[going]
            if not len(live):
                break
            every = np.arange(len(live))
            symbols[every, at] = ids[every, at]
            back = np.minimum(span + (span > at[:, None]), width - 1)
            symbols = np.take_along_axis(symbols, back, 1)
            symbols[:, -1] = self.STRANGE
            back = np.minimum(span + (span >= at[:, None]), width - 1)
            ranks, ids = np.take_along_axis(ranks, back, 1), np.take_along_axis(ids, back, 1)
            ranks[:, -1] = self.NEVER
            ranks[every, at], ids[every, at] = self.look(symbols[every, at], symbols[every, np.minimum(at + 1, width - 1)])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1], ids[left, at[left] - 1] = self.look(symbols[left, at[left] - 1], symbols[left, at[left]])
        return done


class Cuts:
    """Cut -> its number; what a cut encodes to stands in flat arrays by that number."""

    WIDTHS = (8, 16, 32)

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.merges = pieces, Merges(pieces)
        raw = [
            bytes([pieces.byte_of[i]]) if i in pieces.byte_of else s.replace(BLANK, " ").encode()
            for i, s in enumerate(pieces.surface)
        ]
        self.width = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.width) - self.width
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.restart()

    def restart(self) -> None:
        self.numbers: dict[str, int] = {}
        self.first, self.ids = array("q", [0]), array("i")
        self.characters = 0

    def learn(self, cuts: list[str]) -> None:
        """Encode new cuts, a bounded number at a time."""
        for begin in range(0, len(cuts), LEARNT):
            self._learn(cuts[begin : begin + LEARNT])

    def _learn(self, cuts: list[str]) -> None:
        """Encode new cuts, short ones together."""
        lengths = np.array(list(map(len, cuts)), np.int64)
        low = 0
        singly = np.flatnonzero(lengths > self.WIDTHS[-1]).tolist()
        for width in self.WIDTHS:
            own = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            if not len(own):
                continue
            named = [cuts[k] for k in own.tolist()]
            points = np.frombuffer("".join(named).encode("utf-32-le"), "<u4")
            inside = np.arange(width) < lengths[own, None]
            symbols = np.full((len(own), width), self.merges.STRANGE, np.int64)
            symbols[inside] = self.merges.symbol[points]
            strange = ((symbols >= self.merges.STRANGE) & inside).any(1)
            singly += own[strange].tolist()
            after = self.merges.apply(symbols[~strange], lengths[own[~strange]])
            kept = after < self.merges.STRANGE
            self._add([c for c, odd in zip(named, strange.tolist(), strict=True) if not odd], after[kept], kept.sum(1))
        if singly:
            ids = [self.pieces.encode_cut(cuts[k]) for k in singly]
            self._add([cuts[k] for k in singly], np.concatenate(ids), np.array(list(map(len, ids))))

    def _add(self, cuts: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        ends = np.cumsum(counts) + len(self.ids)
        number = len(self.first) - 1
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.first.frombytes(ends.astype(np.int64).tobytes())
        self.numbers.update(zip(cuts, range(number, number + len(cuts)), strict=True))
        self.characters += sum(map(len, cuts))

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Offsets by text, ids, and begins and ends in source bytes."""
        if all(len(text) <= STRETCH for text in texts):
            return self._encoded(texts)
        offsets = [0]
        found: list[list[np.ndarray]] = [[], [], []]
        for text in texts:
            n = at = 0
            for part in self.pieces.stretches(text):
                _, ids, begins, ends = self._encoded([part], at > 0)
                for all_, own in zip(found, (ids, begins + at, ends + at), strict=True):
                    all_.append(own.astype(np.int32))
                n, at = n + len(ids), at + len(part.encode())
            offsets.append(offsets[-1] + n)
        return np.array(offsets), *map(np.concatenate, found)

    def _encoded(self, texts: list[str], inside: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same of texts, or stretches inside of texts, that are encoded at once."""
        if len(self.first) > REMEMBERED or self.characters + len(self.ids) > HELD:
            self.restart()
        pieces, aligned = self.pieces, {}
        cuts: list[str] = []
        cuts_of = [0]
        for k, text in enumerate(texts):
            if pieces.plain and BLANK not in text:
                normal = ("" if inside else BLANK) + text.replace(" ", BLANK) if text else ""
            else:
                normal, aligned[k] = pieces.normalize(text, inside)
            cuts += pieces.cuts.findall(normal)
            cuts_of.append(len(cuts))
        numbers = list(map(self.numbers.get, cuts))
        if None in numbers:
            self.learn(list({c for c, n in zip(cuts, numbers, strict=True) if n is None}))
            numbers = list(map(self.numbers.__getitem__, cuts))
        picked = np.array(numbers, np.int64)
        first = np.frombuffer(self.first, np.int64)
        counts = first[picked + 1] - first[picked]
        stops = np.cumsum(counts)
        total = int(stops[-1]) if len(stops) else 0
        at = np.arange(total) + np.repeat(first[picked] - (stops - counts), counts)
        offsets = np.concatenate(([0], stops))[cuts_of]
        ids = np.frombuffer(self.ids, np.int32)[at] if total else np.zeros(0, np.int32)
        upto = np.concatenate(([0], np.cumsum(self.width[ids])))
        lengths = np.diff(offsets)
        shift = np.repeat(upto[offsets[:-1]] + int(pieces.plain and not inside), lengths)  # the first mark has no bytes
        begins, ends = np.maximum(upto[:-1] - shift, 0), np.maximum(upto[1:] - shift, 0)
        for k, places in aligned.items():
            own = slice(int(offsets[k]), int(offsets[k + 1]))
            begins[own], ends[own] = _project(pieces.characters(ids[own].tolist()), places)
        return offsets, ids, begins, ends

    def decoded(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of the id lists."""
        blob, bounds = bytearray(), np.zeros(len(offsets), np.int64)
        for begin in range(0, len(ids), RUN):
            own = ids[begin : begin + RUN]
            widths = self.width[own]
            upto = np.concatenate(([0], np.cumsum(widths)))
            inside = (offsets > begin) & (offsets <= begin + RUN)
            bounds[inside] = len(blob) + upto[offsets[inside] - begin]
            blob += self.raw[np.arange(int(upto[-1])) + np.repeat(self.start[own] - upto[:-1], widths)].tobytes()
        raw = np.frombuffer(blob, np.uint8)
        if self.pieces.prefix:
            skip = np.zeros(len(offsets) - 1, np.int64)
            full = np.flatnonzero(np.diff(bounds))
            skip[full] = raw[bounds[full]] == 0x20
        try:
            if not self.pieces.prefix or self.pieces.squeeze:
                raise ValueError
            blob.decode()
            texts = [blob[b:e].decode() for b, e in zip((bounds[:-1] + skip).tolist(), bounds[1:].tolist(), strict=True)]
        except ValueError:
            texts = [self.pieces.decode(ids[b:e].tolist()) for b, e in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.array(texts, pa.string())


_MADE: dict[str, Cuts] = {}


def cuts_of_model(pieces: Pieces) -> Cuts:
    """The tables of a model, made once in a process: tasks of reused workers share them."""
    if pieces.name not in _MADE:
        _MADE.clear()
        _MADE[pieces.name] = Cuts(pieces)
    return _MADE[pieces.name]


def _project(characters: list[int], places: list[int]) -> tuple[list[int], list[int]]:
    """Byte spans of pieces from the characters they complete; a byte piece of a character
    that stands for itself gets its own byte, else a place within the character's span."""
    begins, ends = [], []
    at = behind = 0
    for held in characters:
        if held == 0 or behind:
            begins.append(min(places[at] + behind, max(places[at + 1] - 1, places[at])))
            ends.append(min(begins[-1] + 1, places[at + 1]))
            behind = 0 if held else behind + 1
        else:
            begins.append(places[at])
            ends.append(places[at + held])
        at += held
    return begins, ends


def encode(
    documents: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", spans: bool = True
) -> DataFrame:
    """``keep`` columns with ids, decoded and (with ``spans``) begins and ends: the source
    bytes [begin, end) of every piece.  ``model`` is the path of a model file on the driver;
    its vocabulary and rules, fixed in size, travel with the tasks."""
    with open(model, "rb") as file:
        shared = documents.sparkSession.sparkContext.broadcast(Pieces(file.read()))
    ship(documents.sparkSession)
    kept = [documents.schema[name] for name in keep]
    ints = T.ArrayType(T.IntegerType(), False)
    added = [T.StructField("ids", ints, False), T.StructField("decoded", T.StringType(), False)]
    if spans:
        added += [T.StructField("begins", ints, False), T.StructField("ends", ints, False)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = cuts_of_model(shared.value)
        for batch in batches:
            for part in slices(batch, "__text", SLICE):
                texts = [t or "" for t in part.column("__text").to_pylist()]
                offsets, ids, begins, ends = cuts.encoded(texts)
                lists = [pa.array(x.astype(np.int32, copy=False)) for x in [ids, *([begins, ends] if spans else [])]]
                lists = [pa.ListArray.from_arrays(offsets.astype(np.int32), x) for x in lists]
                columns = [*[part.column(n) for n in keep], lists[0], cuts.decoded(offsets, ids), *lists[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *[f.name for f in added]])

    rows = documents.select(*keep, documents[text].alias("__text"))
    return rows.mapInArrow(work, T.StructType([*kept, *added]))
