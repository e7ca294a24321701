"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a Viterbi pass.

White space: each space is written as U+2581 and one is put in front of a text that isn't empty.
The encoding has the highest sum of piece scores; a character that is no piece of its own costs
the lowest score less 10 and is written as its UTF-8 bytes. On ties the longest last piece wins.
A U+2581 of the text itself goes as bytes, so decode(encode(text)) is the text, always.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: What stands for an id without a piece.
UNREADABLE = "\ufffd".encode()
#: Segments that a worker remembers at most; then it starts anew. Longer segments are not kept.
REMEMBER, KEEP_CHARS = 300_000, 48
#: Documents of one output batch.
ROWS = 256


def default_model() -> str:
    """Path of the public 32k-piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> tuple[list[tuple[str, float, int]], list[bytes], int]:
    """(piece, score, id) of the pieces to match, the bytes that each id stands for, the id of byte 0."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    match, said, byte0 = [], [], sp.piece_to_id("<0x00>")
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            said.append(bytes([i - byte0]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            said.append(b"")
        else:
            match.append((piece, sp.get_score(i), i))
            said.append(piece.replace(SPACE, " ").encode())
    return match, said, byte0


class Codec:
    """Encodes and decodes with one vocabulary; remembers the ids of short segments."""

    def __init__(self, match: list[tuple[str, float, int]], said: list[bytes], byte0: int) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score, i in match:
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.chars = {p for p, _, _ in match if len(p) == 1}
        self.unknown = min((s for _, s, _ in match if s > -1e8), default=0.0) - 10
        self.said, self.byte0, self.known = said, byte0, {}
        # No piece has a space sign behind another character, so texts fall apart before spaces; likewise at
        # line ends, if no piece holds one: the best path of the whole is the best paths of the parts.
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in match):
            self.split = lambda s: [s]
        elif any("\n" in p for p, _, _ in match):
            self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        else:
            self.split = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall

    def viterbi(self, s: str) -> list[int]:
        """Ids of the best path through s, which has its spaces replaced."""
        n, at = len(s), 0
        best, last = [float("-inf")] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0

        def reach(end: int, at: int) -> int:
            while at < end:
                if s[at] not in self.chars:
                    best[at + 1], last[at + 1] = best[at] + self.unknown, (at, -1)
                at += 1
            return at

        for end, (length, score, i) in self.automaton.iter(s):
            at = reach(end + 1, at)
            start = end + 1 - length
            if best[start] + score > best[end + 1]:
                best[end + 1], last[end + 1] = best[start] + score, (start, i)
        reach(n, at)
        out = []
        while n:
            start, i = last[n]
            if i < 0:
                out.extend(self.byte0 + b for b in reversed(s[start:n].encode("utf-8", "surrogatepass")))
            else:
                out.append(i)
            n = start
        return out[::-1]

    def segment(self, s: str) -> bytes:
        got = self.known.get(s)
        if got is None:
            got = np.array(self.viterbi(s), np.int32).tobytes()
            if len(s) <= KEEP_CHARS:
                if len(self.known) >= REMEMBER:
                    self.known.clear()
                self.known[s] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """The ids as bytes of int32; none for an empty or null text."""
        if not text:
            return b""
        own = np.array([self.byte0 + b for b in SPACE.encode()], np.int32).tobytes()
        segment = self.segment
        parts = text.split(SPACE)
        parts[0] = " " + parts[0]
        return own.join([b"".join([segment(x) for x in self.split(p.replace(" ", SPACE))]) for p in parts])

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; an id that no piece has, and bytes that make no character, read as U+FFFD."""
        said, n = self.said, len(self.said)
        got = b"".join([said[i] if 0 <= i < n else UNREADABLE for i in ids.tolist()])
        try:
            return got.decode("utf-8", "surrogatepass")[1:]
        except UnicodeDecodeError:
            return got.decode("utf-8", "replace")[1:]


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per worker process and vocabulary."""
    if shared.value is not None and id(shared.value) not in _CODECS:
        _CODECS.clear()
        _CODECS[id(shared.value)] = Codec(*shared.value)
    return _CODECS[id(shared.value)]


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 (of the text decoded from the ids), round_trip.

    No shuffle; the vocabulary (bounded by its file) is broadcast. A null text is like an empty
    one: no ids, and it decodes to the empty text. Whole texts of any length are read. Repeated
    rows come out repeated, an empty table gives an empty one, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model or default_model()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                b = whole.slice(at, ROWS)
                texts = b.column("text").to_pylist()
                coded = [codec.encode(t) for t in texts]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                back = [codec.decode(np.frombuffer(c, np.int32)) for c in coded]
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                sha = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back])
                same = pa.array([t == (o or "") for t, o in zip(back, texts, strict=True)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes), ids, sha, same], ["doc_id", "n_tokens", "ids", "decoded_sha256", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text: the texts of the ids in encoded (doc_id, ids); other columns are ignored.

    Null ids give an empty text. An id that is null or no piece's, and bytes that make no character,
    as where ids were cut, read as U+FFFD. An empty table gives an empty one.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model or default_model()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for b in batches:
            texts = [codec.decode(np.array([-1 if x is None else x for x in i or []], np.int64)) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(work, "doc_id long, text string")


def op5_pieces(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents, with the digest of the text that they decode to."""
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_pieces": op5_pieces}
ORACLES: dict[str, str] = {}
