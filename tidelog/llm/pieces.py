"""SentencePiece encoding and decoding (operator 1) by weighted finite-state transducers.

Three transducers are compiled from the model file:

* the normaliser N: code points to symbols, spaces to the space symbol, one space symbol before the text;
* the pieces P: a trie whose paths spell pieces and whose final arcs emit their ids;
* the byte fallback B: for a symbol that no piece spells, one path that emits its UTF-8 bytes' ids.

An input is composed with N and with the closure of P and B lazily, position by position, and the path of
least weight in the tropical semiring (minimum, plus) is taken. A unigram model weighs a piece by its
negated score. A merge model (BPE) weighs each piece one and lets piece b follow piece a only if merging the
two spelled side by side gives just [a, b] (any other arc weighs infinity). A token sequence is the result of the
merges exactly if all its neighbours pass that test, so one path of finite weight remains, and it is what the
merges would give. Prefixes have one such path too, so one survivor for each position is kept.

Where no piece of the model spells two neighbouring symbols side by side, no path crosses: inputs are cut before
space symbols (if that holds for them; checked when the model is compiled), words are cut at such places, and
the paths of words and parts are remembered, in tables of bounded size.

Defined cases. Null text: null ids, no tokens, round trip true. Empty text: no ids. Code points that no piece
spells: bytes. The space symbol itself in a text decodes to a space, as the model defines; round_trip is
false there. Empty table: no rows. Repeated rows: each gets its own row. Further columns are ignored. Texts
are never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import arrays
from tidelog.llm.scratch import bounded_batches

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED, REMEMBERED_CHARS = 150_000, 4_000_000  # words of a generation and their characters; a worker keeps two generations
_RUNS, _RUNS_ONLY = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"), re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
IDS = "ids array<int>"


class Transducer:
    """The composed transducer N o (P | B)* of one model file."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.byte_id, self.ids, self.weight = {}, {}, {}
        for i, name in enumerate(self.names):
            if model.is_byte(i):
                self.byte_id[int(name[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[name] = i
                self.weight[name] = model.get_score(i)
        self.merges = _model_type(Path(model_file).read_bytes()) == 2
        self.splits = not any(SPACE in name.lstrip(SPACE) for name in self.ids)
        self.trie = self._compile()
        self.joins = {name[i : i + 2] for name in self.ids for i in range(len(name) - 1)}
        self.breaks = not any("\n" in name for name in self.ids)
        is_byte = {v: k for k, v in self.byte_id.items()}
        self.spelled = [bytes([is_byte[i]]) if i in is_byte else name.encode() for i, name in enumerate(self.names)]
        self.code = np.uint16 if len(self.names) <= 1 << 16 else np.uint32
        self.words: dict[str, bytes] = {}  # paths, packed
        self.before: dict[str, bytes] = {}  # the generation before
        self.held = 0  # characters of the remembered words
        self.follows: dict[str, dict[str, bool]] = {}

    def _compile(self) -> dict:
        """P as nested arcs: symbol -> (the piece that ends there or None, the arcs that go on)."""
        root: dict = {}
        for name in sorted(self.ids):
            at = root
            for c in name[:-1]:
                at = at.setdefault(c, (None, {}))[1]
            at[name[-1]] = (name, at[name[-1]][1] if name[-1] in at else {})
        return root

    def normalise(self, text: str) -> str:
        """N: spaces to the space symbol, one before the text (nothing for an empty text)."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def _merged(self, symbols: str) -> list[str]:
        """The merges of a short string: the best-scored neighbouring pair first, the leftmost of equals."""
        parts = list(symbols)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.weight.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, a: str, b: str) -> bool:
        """Whether the arc of piece b leaves a state that piece a ended."""
        return self._merged(a + b) == [a, b]

    def _after(self, a: str) -> dict[str, bool]:
        """The remembered answers of may_follow(a, .)."""
        found = self.follows.get(a)
        if found is None:
            if len(self.follows) >= REMEMBERED:
                self.follows.clear()
            found = self.follows[a] = {}
        return found

    def shortest(self, symbols: str) -> list[int]:
        """Ids on the path of least weight through the composition with symbols."""
        n, merges, weight = len(symbols), self.merges, self.weight
        cost: list[float | None] = [None] * (n + 1)
        last: list[str] = [""] * (n + 1)  # the piece (or, by fallback, the symbol) that ended the survivor
        cost[0] = 0.0
        for i in range(n):
            here = cost[i]
            if here is None:
                continue
            arcs, j, spelled = self.trie, i, False
            after = self._after(last[i]) if merges and i else None
            while j < n:
                arc = arcs.get(symbols[j])
                if arc is None:
                    break
                piece, arcs = arc
                j += 1
                if piece is None:
                    continue
                if j == i + 1:
                    spelled = True
                if merges:
                    if cost[j] is not None:  # the one path of finite weight to there is known
                        continue
                    if after is not None:
                        ok = after.get(piece)
                        if ok is None:
                            ok = after[piece] = self.may_follow(last[i], piece)
                        if not ok:
                            continue
                    cost[j], last[j] = here + 1, piece
                else:
                    w = here - weight[piece]
                    known = cost[j]
                    if known is None or w < known:
                        cost[j], last[j] = w, piece
            if not spelled:  # byte fallback; a symbol without a piece merges with nothing
                w = here + (1 if merges else 1e9)
                if cost[i + 1] is None or w < cost[i + 1]:
                    cost[i + 1], last[i + 1] = w, symbols[i]
        out: list[int] = []
        while n:
            piece = last[n]
            n -= len(piece)
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            else:
                out += [self.byte_id[b] for b in reversed(piece.encode("utf-8", "surrogatepass"))]
        return out[::-1]

    def _words(self, symbols: str) -> list[str]:
        """symbols cut where no path crosses: before runs of space symbols, and around a newline that no piece holds."""
        if not self.splits:
            return [symbols]
        if SPACE * 2 in symbols or "\x00" in symbols:
            return (_RUNS if self.breaks else _RUNS_ONLY).findall(symbols)
        cut = symbols.replace(SPACE, f"\x00{SPACE}")
        return (cut.replace("\n", "\x00\n\x00") if self.breaks else cut).split("\x00")

    def _path(self, word: str) -> bytes:
        """The packed path of a word: its parts' paths, where no piece spells both neighbours of a cut."""
        known, joins, first, parts = self.words, self.joins, 0, []
        for i in range(1, len(word) + 1):
            if i < len(word) and word[i - 1 : i + 1] in joins:
                continue
            part = word[first:i]
            first = i
            path = known.get(part) or self.before.get(part)
            if path is None:
                path = np.array(self.shortest(part), self.code).tobytes()
            if part != word:
                known[part] = path
            parts.append(path)
        return b"".join(parts)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        words = self._words(self.normalise(text))
        if len(self.words) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self.before, self.words, self.held = self.words, {}, 0
        known, before = self.words, self.before
        for word in set(words).difference(known):
            path = before.get(word)
            known[word] = path if path is not None else self._path(word)
            self.held += len(word)
        return np.frombuffer(b"".join(map(known.__getitem__, words)), self.code)

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The inverse: spelled pieces, runs of bytes as UTF-8, without the space symbol before the text."""
        spelled = self.spelled
        text = b"".join([spelled[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def _field(data: bytes, number: int) -> list:
    """Values of one field of a protocol-buffer message."""
    at, found = 0, []
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else (8 if kind == 1 else 4, at)
            value, at = data[at : at + size], at + size
        if key >> 3 == number:
            found.append(value)
    return found


def _model_type(data: bytes) -> int:
    """1 for a unigram model, 2 for a merge model: field 3 of the trainer's part, field 2 of the file."""
    return (_field(_field(data, 2)[0], 3) or [1])[0]


_LOADED: dict[str, Transducer] = {}


def load(model_file: str) -> Transducer:
    """The transducer of a file, compiled once in each worker."""
    if model_file not in _LOADED:
        _LOADED[model_file] = Transducer(model_file)
    return _LOADED[model_file]


def _ids_array(found: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0, *(0 if x is None else len(x) for x in found)])
    flat = np.concatenate([x for x in found if x is not None] or [np.zeros(0)]).astype(np.int32)
    missing = pa.array([x is None for x in found], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat), mask=missing)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL) -> DataFrame:
    """doc_id, ids, round_trip (the ids decode to the text) for every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = load(model_file)
        for batch in batches:
            for first, end, _, _ in arrays.slices(batch.column("text")):
                part = batch.slice(first, end - first)
                texts = part.column("text").to_pylist()
                ids = [None if t is None else fst.encode(t) for t in texts]
                same = [t is None or fst.decode(i) == t for t, i in zip(texts, ids, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _ids_array(ids), pa.array(same, pa.bool_())], ["doc_id", "ids", "round_trip"])
        batch = part = texts = ids = same = None
        arrays.give_back()

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {IDS}, round_trip boolean")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_file: str = MODEL) -> DataFrame:
    """doc_id, text for every row of ids; null ids give null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = load(model_file)
        for batch in batches:
            texts = [None if x is None else fst.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")
