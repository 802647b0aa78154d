"""SentencePiece encoding that keeps byte offsets, and decoding.

The model file's compiled character map (a double-array trie) is searched for the longest prefix at each place of the
text; what it replaces, the dummy prefix and the escaped spaces all record where they come from, so each piece of the
normalised text is projected to the bytes of the original. Pieces are then merged by score, leftmost first among equal
scores; characters outside the vocabulary become byte pieces.

The normalised text is cut where no piece of the vocabulary can reach across (before spaces and around characters that
are in no longer piece); each cut-out chunk is merged once and kept in a cache of the worker. A vocabulary with pieces
across spaces is merged whole.

Models with user-defined or unused pieces, spaces as suffixes, or another algorithm than merging are refused. Null text
is empty: no ids and the digest of nothing. Rows are independent: repeated rows, ties and null ids keep their own
result, an empty table gives an empty result, extra columns are left out.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from struct import pack, unpack

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larderline.llm.common import arrow_map, column_of, table, texts_of
from larderline.llm.pretokens import Cache

SPACE = "▁"

#: Letters of words that may end in a run of marks; any class is right, since the vocabulary is asked about it.
LETTERS = "A-Za-zÀ-ÖØ-öø-\u024f\u0370-\u04ff"

# Fixed values of the model format: kinds of pieces, the algorithm's number, field numbers of the messages.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
            continue
        size = number() if wire == 2 else 4 if wire == 5 else 8
        yield key >> 3, message[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes, whose leaves point to the replacements."""

    def __init__(self, blob: bytes) -> None:
        size = unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.targets = blob[4 + size :]
        # An ASCII character that no entry replaces alone or together with another ASCII character stays as it is.
        inert = [c for c in range(128) if not self.units or not self._changes(c)]
        self.inert = re.compile("[%s]+(?=[\\x00-\\x7f]|$)" % "".join(f"\\x{c:02x}" for c in inert)) if inert else None

    def _step(self, node: int, byte: int) -> tuple[int, int] | None:
        """The node behind ``byte`` and the place of its replacement (-1: none)."""
        unit = self.units[node ^ byte]
        if unit & 0x800000FF != byte:
            return None
        after = node ^ byte ^ (unit >> 10 << ((unit & 512) >> 6))
        return after, self.units[after] & 0x7FFFFFFF if unit >> 8 & 1 else -1

    def _root(self) -> int:
        unit = self.units[0]
        return unit >> 10 << ((unit & 512) >> 6)

    def _changes(self, first: int) -> bool:
        found = self._step(self._root(), first)
        if found is None:
            return False
        return found[1] >= 0 or any(self._step(found[0], second) for second in range(1, 128))

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length of the longest entry that starts at ``at``, and its replacement."""
        if not self.units:
            return None
        node, best = self._root(), None
        for place in range(at, len(data)):
            found = self._step(node, data[place])
            if found is None:
                break
            node, target = found
            if target >= 0:
                best = place + 1 - at, target
        if best is None:
            return None
        return best[0], self.targets[best[1] : self.targets.index(b"\0", best[1])].decode()


class Normalizer:
    def __init__(self, spec: bytes) -> None:
        options = {3: 1, 4: 1, 5: 1} | dict(fields(spec))
        self.map = CharacterMap(options.get(2, b""))
        self.dummy_prefix, self.squeeze, self.escape = bool(options[3]), bool(options[4]), bool(options[5])
        self.space = SPACE if self.escape else " "

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the byte of the original it comes from."""
        data = text.encode()
        if self.map.units or self.squeeze:
            return self.replaced(text, data)
        if not text:
            return "", np.zeros(1, np.int64)
        starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        head = [0] if self.dummy_prefix else []
        made = (self.space if self.dummy_prefix else "") + (text.replace(" ", SPACE) if self.escape else text)
        return made, np.concatenate([head, starts, [len(data)]]).astype(np.int64)

    def entries(self, text: str, data: bytes) -> Iterator[tuple[int, str]]:
        """Bytes read and text written, from left to right."""
        at = place = 0
        inert = self.map.inert
        while place < len(text):
            run = inert.match(text, place) if inert else None
            if run:
                for c in run.group():
                    yield 1, c
                place = run.end()
                at += run.end() - run.start()
                continue
            found = self.map.longest(data, at)
            if found is None:
                size = len(text[place].encode())
                yield size, text[place]
                place += 1
            else:
                size = found[0]
                yield found
                place += len(data[at : at + size].decode())
            at += size

    def replaced(self, text: str, data: bytes) -> tuple[str, np.ndarray]:
        made: list[str] = []
        sources: list[int] = []
        at, started, after_space = 0, False, self.squeeze
        for size, target in self.entries(text, data):
            if not started and not (self.squeeze and target == " "):
                started = True
                if self.dummy_prefix:
                    made.append(self.space)
                    sources.append(at)
            if started:
                if after_space:
                    target = target.lstrip(" ")
                if target:
                    made += target.replace(" ", self.space)
                    sources += [at] * len(target)
                    after_space = self.squeeze and target.endswith(" ")
            at += size
        if self.squeeze:
            while made and made[-1] == self.space:
                made.pop()
                at = sources.pop()
        return "".join(made), np.array([*sources, at], np.int64)


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


class Model:
    """Encoder and decoder of one model file."""

    def __init__(self, proto: bytes, cached: int = 300_000) -> None:
        kept: dict[int, list] = {PIECES: [], TRAINER: [b""], NORMALIZER: [b""]}
        for name, value in fields(proto):
            if name in kept:
                kept[name].append(value)
        pieces = [dict(fields(p)) for p in kept[PIECES]]
        trainer = dict(fields(kept[TRAINER][-1]))
        names = [p[1].decode() for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != BPE or trainer.get(24, 0) or {USER_DEFINED, UNUSED} & set(kinds):
            raise ValueError("only merging models without user-defined pieces, unused pieces and spaces as suffixes")
        self.normalizer = Normalizer(b"".join(kept[NORMALIZER]))
        scores = [unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        normal = [i for i, kind in enumerate(kinds) if kind == NORMAL]
        self.ids = {names[i]: i for i in normal}
        places = {s: n for n, s in enumerate(sorted({scores[i] for i in normal}, reverse=True))}
        #: Pieces of two characters or more and the order of their scores (0: merged first).
        self.order = {names[i]: places[scores[i]] for i in normal if len(names[i]) > 1}
        self.unknown = kinds.index(UNKNOWN)
        by_byte = {int(names[i][3:5], 16): i for i, kind in enumerate(kinds) if kind == BYTE}
        self.bytes = [by_byte[b] for b in range(256)] if trainer.get(35, 0) else None
        self.byte_of = {i: b for b, i in by_byte.items()}
        self.names = names
        surface = trainer.get(44, " ⁇ ".encode()).decode()
        shown = {NORMAL: lambda n: n.replace(SPACE, " "), UNKNOWN: lambda n: surface, CONTROL: lambda n: "", BYTE: lambda n: None}
        self.shown = [shown[kind](n) for n, kind in zip(names, kinds)]
        self.opens = {i for i in normal if names[i].startswith(SPACE)}
        self.drops_prefix, self.drops_all = self.normalizer.dummy_prefix or self.normalizer.squeeze, self.normalizer.squeeze
        self.control = {i for i, kind in enumerate(kinds) if kind == CONTROL}
        self.cuts = self._cuts()
        self.cache = Cache(self.merged, cached)
        codecs.register_error("larderline_each_byte", _each_byte)

    def _cuts(self) -> re.Pattern:
        """Chunks that no merge can cross: cut before spaces, around characters without a longer piece, and before a
        trailing run of marks if no piece ends with such a run after another character."""
        if any(SPACE in name.lstrip(SPACE) for name in self.order):
            return re.compile(".+", re.DOTALL)
        inside = set("".join(self.order))
        alone = re.escape("".join(c for c in map(chr, range(128)) if c not in inside))
        marks = "".join(c for c in map(chr, range(33, 127)) if c in inside and not c.isalnum())
        crossing = re.compile(f"[{LETTERS}]([{re.escape(marks)}])[{re.escape(marks)}]*$") if marks else re.compile("$.")
        crossed = {found[1] for found in map(crossing.search, self.order) if found}
        marks = re.escape("".join(c for c in marks if c not in crossed))
        ways = [f"{SPACE}*[^{SPACE}{alone}]+", f"{SPACE}+"]
        end = f"(?=[{SPACE}{alone}]|$)"
        if marks:
            ways.insert(0, f"{SPACE}*[^{SPACE}{alone}]*[{LETTERS}](?=[{marks}]+{end})")
        if alone:
            ways.insert(0, f"[{alone}]")
        return re.compile("|".join([f"{SPACE}*[{LETTERS}]+{end}", *ways]))

    def cut_by_scanning(self, chunk: str) -> list[str]:
        """Merges of a short chunk: the first of the lowest orders is looked for anew each time."""
        get, never = self.order.get, len(self.ids)
        parts = [*chunk]
        waits = [get(chunk[i : i + 2], never) for i in range(len(chunk) - 1)]
        while waits:
            least = min(waits)
            if least == never:
                break
            i = waits.index(least)
            parts[i] += parts.pop(i + 1)
            del waits[i]
            if i < len(waits):
                waits[i] = get(parts[i] + parts[i + 1], never)
            if i:
                waits[i - 1] = get(parts[i - 1] + parts[i], never)
        return parts

    def cut_by_queue(self, chunk: str) -> list[str]:
        """The same for a chunk of any length: a linked list and a queue of pairs, whose stale entries are skipped."""
        n, order = len(chunk), self.order
        ends, left, right = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        waits = [order.get(chunk[i : i + 2]) for i in range(n - 1)]
        waits.append(None)
        queue = [(rank, i) for i, rank in enumerate(waits) if rank is not None]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            if waits[i] != rank:
                continue
            j = right[i]
            ends[i] = end = ends[j]
            waits[j] = None
            right[i] = after = right[j]
            waits[i] = new = order.get(chunk[i : ends[after]]) if after < n else None
            if new is not None:
                heappush(queue, (new, i))
            if after < n:
                left[after] = i
            before = left[i]
            if before >= 0:
                new = order.get(chunk[before:end])
                if new != waits[before]:
                    waits[before] = new
                    if new is not None:
                        heappush(queue, (new, before))
        parts, i = [], 0
        while i < n:
            parts.append(chunk[i : ends[i]])
            i = right[i]
        return parts

    def merged(self, chunk: str) -> tuple[bytes, bytes, str, int]:
        """Ids and ends (in characters of the chunk) as 32-bit integers, the ids as text, and the chunk's length."""
        parts = self.cut_by_scanning(chunk) if len(chunk) <= 32 else self.cut_by_queue(chunk)
        ids: list[int] = []
        places: list[int] = []
        at, get = 0, self.ids.get
        for part in parts:
            known = get(part)
            begin, at = at, at + len(part)
            if known is not None:
                ids.append(known)
                places.append(at)
            elif self.bytes:
                made = [self.bytes[b] for b in part.encode()]
                ids += made
                # As the library has it: the last byte piece of a character holds its span.
                places += [begin] * (len(made) - 1) + [at]
            elif ids and ids[-1] == self.unknown:
                places[-1] = at
            else:
                ids.append(self.unknown)
                places.append(at)
        return pack(f"<{len(ids)}I", *ids), pack(f"<{len(ids)}I", *places), "".join([f"{x}," for x in ids]), len(chunk)

    def pieces(self, text: str) -> tuple[list[tuple[bytes, bytes, str, int]], np.ndarray]:
        """The merged chunks of a text, and the source of each character of the normalised text."""
        normal, source = self.normalizer(text)
        chunks = self.cuts.findall(normal)
        return list(map(self.cache.__getitem__, chunks)), source

    @staticmethod
    def spans(chunks: list[tuple[bytes, bytes, str, int]], source: np.ndarray) -> np.ndarray:
        """Bytes of the original at which the pieces end; each begins where the one before ends, the first at source[0]."""
        ends = np.frombuffer(b"".join([c[1] for c in chunks]), "<u4").astype(np.int64)
        sizes = np.array([c[3] for c in chunks], np.int64)
        counts = np.array([len(c[1]) >> 2 for c in chunks], np.int64)
        return source[ends + np.repeat(np.cumsum(sizes) - sizes, counts)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids, the original byte at which each piece ends, and the one at which the first begins."""
        chunks, source = self.pieces(text)
        ids = np.frombuffer(b"".join([c[0] for c in chunks]), "<u4").astype(np.int64)
        ends = self.spans(chunks, source)
        if not self.bytes and len(ids) > 1:
            # Unknown pieces side by side are one, also across a cut.
            keep = np.append(~((ids[1:] == self.unknown) & (ids[:-1] == self.unknown)), True)
            ids, ends = ids[keep], ends[keep]
        return ids, ends, int(source[0])

    def decode(self, ids: list[int]) -> str:
        shown = list(map(self.shown.__getitem__, ids))
        # The space that stands for the dummy prefix goes: of the first piece that says anything, if it opens with one.
        if self.drops_prefix:
            for at, i in enumerate(ids):
                if i in self.control:
                    continue
                if i not in self.opens:
                    break
                shown[at] = shown[at][1:]
                if not self.drops_all or shown[at]:
                    break
        if None not in shown:
            return "".join(shown)
        made, raw = [], bytearray()
        for i, part in zip(ids, shown):
            if part is None:
                raw.append(self.byte_of[i])
                continue
            if raw:
                made.append(raw.decode("utf-8", "larderline_each_byte"))
                raw.clear()
            made.append(part)
        made.append(raw.decode("utf-8", "larderline_each_byte"))
        return "".join(made)


_MODELS: dict[str, Model] = {}


def worker_model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS.clear()
        with open(path, "rb") as file:
            _MODELS[path] = Model(file.read())
    return _MODELS[path]


def encoded(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids and the byte spans (begins, ends; end exclusive) of the pieces of every whole text."""

    def start():
        model = worker_model(model_path)

        def rows(batch):
            ids, begins, ends = [], [], []
            for text in texts_of(batch):
                made, last, first = model.encode(text)
                ids.append(made)
                ends.append(last)
                begins.append(np.concatenate([[first], last[:-1]]).astype(np.int64) if len(last) else last)
            return {"doc_id": column_of(batch, "doc_id"), "ids": ids, "begins": begins, "ends": ends}

        return rows

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, begins array<long>, ends array<long>"
    return arrow_map(documents.select("doc_id", "text"), schema, None, start)


def decoded(ids: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids; null ids give null."""

    def start():
        model = worker_model(model_path)
        return lambda batch: {
            "doc_id": column_of(batch, "doc_id"),
            "text": [None if x is None else model.decode(x) for x in column_of(batch, "ids").to_pylist()],
        }

    kind = ids.schema["doc_id"].dataType.simpleString()
    return arrow_map(ids.select("doc_id", "ids"), f"doc_id {kind}, text string", None, start)


def round_trip(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids, of the text decoded from them and of the ends of the spans; one pass.

    ``spans_sha256`` is the digest of the byte at which each piece ends in the original, as little-endian 64-bit
    integers; ``covered`` is the number of original bytes between the first piece's begin and the last one's end.
    """

    def start():
        model = worker_model(model_path)

        def digests(batch):
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "spans_sha256": [], "covered": []}
            for text in texts_of(batch):
                if model.bytes:
                    chunks, source = model.pieces(text)
                    ids = np.frombuffer(b"".join([c[0] for c in chunks]), "<u4").tolist()
                    ends, first, listed = model.spans(chunks, source), int(source[0]), "".join([c[2] for c in chunks])[:-1]
                else:
                    made, ends, first = model.encode(text)
                    ids = made.tolist()
                    listed = ",".join(map(str, ids))
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha256(listed.encode()).hexdigest())
                out["decoded_sha256"].append(sha256(model.decode(ids).encode()).hexdigest())
                out["spans_sha256"].append(sha256(ends.astype("<i8").tobytes()).hexdigest())
                out["covered"].append(int(ends[-1]) - first if len(ends) else 0)
            return {"doc_id": column_of(batch, "doc_id")} | out

        return digests

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, covered long"
    return arrow_map(documents.select("doc_id", "text"), schema, None, start)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
