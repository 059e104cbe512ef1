"""SentencePiece encoding and decoding by weighted finite-state transducers.

A model file is compiled into three transducers: the normaliser (longest-match
replacements, the dummy prefix, blanks to a visible mark), the pieces (a prefix
tree, every path of which may be followed by any other), and byte fallback (a
character without a piece becomes the pieces of its bytes). Encoding composes
the input with them and takes the path of least weight in the tropical semiring:
weights add along a path, and the least sum wins.

* Unigram models: a piece weighs its negative log-probability.
* BPE models: a step from one piece to the next weighs 0 if joining the two
  would leave them as they are (merging their characters best score first gives
  exactly these two pieces), and infinity if not. Exactly one path is free, and
  it is the model's segmentation. The states of the transducer are the pieces,
  and its steps are worked out when first asked for.

No piece reaches across a blank, a character that is in no longer piece, or two
neighbours that no piece holds together, so a text is cut there, and the shortest
paths of its cuts join up to its own. Tasks remember the paths of recent cuts.

Decoding runs the transducers the other way: pieces to bytes, marks to blanks,
without the dummy prefix. A text round-trips unless the normaliser changes it or
it contains the mark itself (or bytes that are not its own).

The vocabulary file's path is a parameter. The driver reads it and sends it to
the tasks; its size does not depend on the data.

Rows: a null text has null tokens, an empty one none. Very long texts are
encoded whole. Repeated rows get equal results, an empty table an empty one.
Other columns are kept as they are, but for columns named like the results.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
BEGINNING = 4              # characters of a piece by which the longest piece is looked up
REMEMBERED = 130_000       # cuts, or steps, a worker process remembers, and as many older ones at most


def _replacements(blob: bytes) -> dict[str, str]:
    """The normaliser's rules, read from its compiled prefix tree."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, strings = np.frombuffer(blob, "<u4", size // 4, 4).tolist(), blob[4 + size:]

    def below(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    rules, stack = {}, [(0, b"")]
    while stack:
        at, key = stack.pop()
        base = at ^ below(units[at])
        if key and units[at] >> 8 & 1:
            begin = units[base] & 0x7FFFFFFF
            rules[key.decode()] = strings[begin:strings.index(b"\0", begin)].decode()
        for c in range(1, 256):
            if (base ^ c) < len(units) and units[base ^ c] & 0x800000FF == c:
                stack.append((base ^ c, key + bytes([c])))
    return rules


class _Memo(dict):
    """Remembers a function of one argument, but not for arguments longer than ``longest``.

    When full its entries become the older ones, of which those used again stay.
    """

    def __init__(self, function, most: int | None = None, longest: int | None = None):
        self.function, self.most, self.longest, self.older = function, REMEMBERED if most is None else most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
            if self.longest and len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Transducer:
    """The compiled model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if trainer.treat_whitespace_as_suffix or any(p.type == USER for p in proto.pieces):
            raise ValueError("suffix blanks and user-defined pieces are not supported")
        self.bpe = trainer.model_type == BPE
        self.rules = _replacements(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.mark = MARK if spec.escape_whitespaces else " "
        self.names = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = [self.names.index(f"<0x{b:02X}>") for b in range(256)] if trainer.byte_fallback else None
        self.unknown_cost = 10 - min(self.score.values(), default=0)
        self._prepare()

    def _prepare(self) -> None:
        self.tree: dict = {}
        for piece, i in () if self.bpe else self.id.items():
            node = self.tree
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i
        longer = [p for p in self.id if len(p) > 1]
        joined = {c for p in longer for c in p}
        self.inside = {p[i:i + 2] for p in longer for i in range(len(p) - 1)}      # neighbours within some piece
        self.reach: dict[str, int] = {}      # the longest piece that begins with these characters, for pieces of so many and more
        for p in sorted(longer, key=len):
            if len(p) >= BEGINNING:
                self.reach[p[:BEGINNING]] = len(p)
        m = re.escape(self.mark)
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined and chr(c) != self.mark)
        if any(self.mark in p.lstrip(self.mark) for p in longer):
            self.cuts = re.compile("(?s).+")
        else:
            # marks that no piece holds after a letter end a word there, so that it is remembered without them
            ends = "".join(re.escape(p) for p in "!\"'(),-./:;?[]{}|" if not any(
                x[0].isalpha() and x[1] == p for x in self.inside))
            word = f"{m}*+[^{m}{alone}{ends}]++(?<=[A-Za-z])(?=[{ends}])|" if ends else ""
            self.cuts = re.compile(f"{f'[{alone}]|' if alone else ''}{word}{m}*[^{m}{alone}]+|{m}+")
        if self.rules:
            self.replace = re.compile("|".join(re.escape(k) for k in sorted(self.rules, key=lambda k: (-len(k), k))))
        self.step = _Memo(self._fits)
        self.paths = _Memo(self._path_bytes, longest=64)
        raw = [p.replace(self.mark, " ").encode() for p in self.names]
        for i, t in enumerate(self.types):
            raw[i] = (bytes([int(self.names[i][3:5], 16)]) if t == BYTE else b"" if t == CONTROL
                      else " ⁇ ".encode() if t == UNKNOWN else raw[i])
        self.raw, self.raw_array = raw, pa.array(raw, pa.large_binary())

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("step", "paths", "cuts", "replace", "tree", "raw", "raw_array", "inside",
                                                              "reach")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._prepare()

    def normalise(self, text: str) -> str:
        if self.rules:
            text = self.replace.sub(lambda m: self.rules[m[0]], text)
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if self.prefix and text:
            text = " " + text
        return text.replace(" ", self.mark)

    def _merged(self, text: str) -> list[str]:
        """BPE of a short string: merge the best-scored neighbours, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and s > best:
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, step: int | tuple[str, str]) -> bool:
        """Whether one piece may follow another; both by their ids in one number, or by name where the first has no id."""
        a, b = step if isinstance(step, tuple) else map(self.names.__getitem__, divmod(step, len(self.names)))
        return a + b not in self.id and self._merged(a + b) == [a, b]

    def shortest_path(self, text: str) -> list[str]:
        """The pieces (or single characters without one) on the path of least weight."""
        return self._free_path(text) if self.bpe else self._cheapest_path(text)

    def _free_path(self, text: str) -> list[str]:
        """The one path of weight 0, found depth first, longest piece first.

        Steps weigh 0 or infinity, so the first path to reach the end is the
        shortest. Every beginning of a text has one free path, so a place that
        leads nowhere is tried once.
        """
        n, pieces, step, reach, size = len(text), self.id, self.step, self.reach, len(self.names)
        path, begins, dead, at, last, last_id = [], [], set(), 0, "", None
        j = min(n, reach.get(text[:BEGINNING], BEGINNING - 1))
        while at < n:
            while j > at:
                piece = text[at:j]
                i = pieces.get(piece)
                if i is not None:
                    if j not in dead and (not last or step[(last, piece) if last_id is None else last_id * size + i]):
                        break
                elif j == at + 1 and j not in dead:     # byte fallback: no step but this one leads over the character
                    break
                j -= 1
            if j > at:
                begins.append(at)
                path.append(piece)
                last, last_id, at = piece, i, j
                j = min(n, at + reach.get(text[at:at + BEGINNING], BEGINNING - 1))
            else:       # back to where this place was reached from, and on with the next shorter piece there
                dead.add(at)
                j, at = at - 1, begins.pop()
                path.pop()
                last = path[-1] if path else ""
                last_id = pieces.get(last)
        return path

    def _cheapest_path(self, text: str) -> list[str]:
        """The path of least cost, by dynamic programming from left to right."""
        n, tree, score = len(text), self.tree, self.score
        cost, back = [math.inf] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            if cost[i] == math.inf:
                continue
            node, single = tree.get(text[i]), text[i]
            if node is None or "" not in node:
                w = cost[i] + self.unknown_cost
                if w < cost[i + 1]:
                    cost[i + 1], back[i + 1] = w, single
            j = i
            while node is not None:
                j += 1
                if "" in node:
                    piece = text[i:j]
                    if cost[i] - score[piece] < cost[j]:
                        cost[j], back[j] = cost[i] - score[piece], piece
                node = node.get(text[j]) if j < n else None
        out, at = [], n
        while at:
            out.append(back[at])
            at -= len(back[at])
        return out[::-1]

    def _path_bytes(self, text: str) -> bytes:
        """The ids of a cut: its path, or the paths of its parts between neighbours that no piece holds together."""
        inside, n = self.inside, len(text)
        ends = [i for i in range(1, n) if text[i - 1:i + 1] not in inside]
        if ends:
            return self._joined([text[a:b] for a, b in zip([0, *ends], [*ends, n])])
        out = []
        for p in self.shortest_path(text):
            i = self.id.get(p)
            out += [i] if i is not None else [self.bytes[b] for b in p.encode()] if self.bytes else [self.unknown]
        return struct.pack(f"<{len(out)}i", *out)

    def _joined(self, cuts: list[str]) -> bytes:
        return b"".join(map(self.paths.__getitem__, cuts))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self._joined(self.cuts.findall(self.normalise(text))), "<i4")

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    def round_trips(self, texts: list[str | None], ids: np.ndarray, n: np.ndarray) -> list[bool | None]:
        """Whether decoding gives each text back; ``ids`` are the pieces of all texts, ``n`` how many each has.

        The bytes of all pieces are laid side by side at once, and compared as bytes: other bytes are
        another text, unless a replacement for bad ones may stand in it.
        """
        laid = self.raw_array.take(pa.array(ids, pa.int32()))
        at = np.append(0, np.cumsum(n))
        held = np.frombuffer(laid.buffers()[1], np.int64)[at].tolist() if len(ids) else [0] * len(at)
        data = laid.buffers()[2].to_pybytes() if len(ids) else b""
        out: list[bool | None] = []
        for i, t in enumerate(texts):
            if t is None:
                out.append(None)
                continue
            a, b = held[i], held[i + 1]
            if self.prefix and a < b and data[a] == 32:
                a += 1
            out.append(data[a:b] == t.encode() or ("\ufffd" in t and self.decode(ids[at[i]:at[i + 1]].tolist()) == t))
        return out


def load(path: str = MODEL) -> Transducer:
    with open(path, "rb") as f:
        return Transducer(f.read())


def encode_documents(docs: DataFrame, model: Transducer, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with tokens (array of int), n_tokens and round_trip (decoding gives the text back)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    own = ("tokens", "n_tokens", "round_trip")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, *own)]
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("tokens", T.ArrayType(T.IntegerType(), False)),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held.value      # compiled, and its memory kept, once for all tasks of a worker process
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(len(keep)).to_pylist()
                ids = [None if t is None else coder.encode(t) for t in texts]
                n = np.array([0 if x is None else len(x) for x in ids], np.int64)
                flat = np.concatenate([np.zeros(0, "<i4"), *[x for x in ids if x is not None]])
                same = coder.round_trips(texts, flat, n)
                offsets = pa.array(np.append(0, np.cumsum(n)).astype(np.int32),
                                   mask=np.append([x is None for x in ids], False).astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(len(keep))],
                     pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                     pa.array([None if x is None else len(x) for x in ids], pa.int64()), pa.array(same, pa.bool_())],
                    names=[f.name for f in schema.fields])

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"]).mapInArrow(run, schema)
