"""Operator 1 — SentencePiece encoding and decoding by a shared-prefix forward pass.

A text becomes ``▁``-marked words (the model has no piece with a mark after
another character, so no piece crosses a word start; a character that is in no
longer piece, such as the line break, is a word of its own). The distinct words of a
batch are sorted, which lays out their trie, and walked depth first: the forward
state of a prefix is computed once and reused by every word that shares it.

The public model is a BPE model, so the forward pass may not simply add piece
scores: the best-scoring segmentation differs from the merge order's. The state
of a prefix is instead the last piece of its encoding. A piece ``t`` may extend
the prefix before it only if the prefix's last piece and ``t``, joined, encode
to just these two pieces; exactly one piece satisfies this at each position
(scores act through the pair test: 0 if it holds, minus infinity if not), and
following the states back gives the ids of the library. Pair tests are small
merges, cached per worker. Words with a run of marks hold pieces of equal score,
whose merges depend on position; these rare words are merged directly.

Characters outside the vocabulary become byte pieces. Decoding joins the pieces'
bytes, turns marks into blanks and removes the one blank that encoding put in
front.

Work is local to a task: no shuffle; memory is bounded by a batch and a cache that starts anew when full.

Defined results: a null text is the empty text, with no ids; a text that holds
the mark itself decodes to a blank in its place, as with the library; repeated
rows and null ids are kept as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm.common import table
from runlens.llm.ragged import PUNCTUATION, Chunks, hold, text_groups

MARK = "▁"
CACHE_CHUNKS = 300_000  # chunks a Python worker keeps
CACHE_PAIRS = 200_000

_state: dict = {}


class Generations(dict):
    """A cache that is emptied in halves: ``clear`` keeps what it holds as the old generation, from which what is asked
    for again comes back."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def __contains__(self, key) -> bool:
        return super().__contains__(key) or key in self.old

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def clear(self) -> None:
        self.old = dict(self)
        super().clear()


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id_of = {pieces[i]: i for i in normal}
        self.score = {pieces[i]: sp.get_score(i) for i in normal}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.surface = [p.replace(MARK, " ").encode() for p in pieces]
        for b, i in enumerate(self.byte_id):
            self.surface[i] = bytes([b])
        for i in range(n):
            if sp.is_control(i):
                self.surface[i] = b""
        self.bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.size = np.fromiter(map(len, self.surface), np.int64, n)
        self.offset = np.cumsum(self.size) - self.size
        joined = {c for p in self.id_of if len(p) > 1 for c in p}
        assert not any(MARK in p.lstrip(MARK) for p in self.id_of), "a piece crosses a word start"
        self.longest = max(map(len, self.id_of))
        # the merge order reaches a piece only if it encodes to itself
        self.reachable = {p: p for p in self.id_of if len(p) == 1 or self.merge(p) == [p]}
        lone = "".join(c for c in "\n\t\r" if c not in joined)
        self.separators = (" " + lone).encode()
        # a run of letters also ends a word, unless some piece joins a letter to the character that follows
        letter = r"[^\W\d_]"
        tied = {b for p in self.id_of for a, b in zip(p, p[1:])
                if re.fullmatch(letter, a) and not re.fullmatch(letter, b)} | {"\0"}
        self.cut = re.compile(f"{MARK}*+{letter}++(?![{re.escape(''.join(sorted(tied)))}])"
                              f"|{MARK}*+[^{MARK}{lone}]++|{MARK}++" + f"|[{lone}]" * bool(lone))
        tails = "".join(c for c in PUNCTUATION.decode() if c not in tied)
        self.encode = Chunks(self._chunks, "<u4", self.separators, tails.encode(), CACHE_CHUNKS // 2)
        self.encode.known = Generations()
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """Merge order on a short string: the best-scoring neighbours first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _together(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merge(left + right) == [left, right]
        return found

    def _ids(self, parts: list[str]) -> bytes:
        out: list[int] = []
        for p in parts:
            i = self.id_of.get(p)
            if i is None:
                out += [self.byte_id[b] for b in p.encode()]
            else:
                out.append(i)
        return np.asarray(out, "<u4").tobytes()

    def _walk(self, words: list[str]) -> dict[str, bytes]:
        """Depth-first walk over the sorted words; last[i] is the last piece of the prefix of length i."""
        out: dict[str, bytes] = {}
        reachable, id_of, longest, together = self.reachable, self.id_of, self.longest, self._together
        last: list[str] = [""]
        before = ""
        for word in words:
            if word.startswith(MARK * 2):
                out[word] = self._ids(self.merge(word))
                continue
            shared, most = 0, min(len(word), len(before), len(last) - 1)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                piece = word[end - 1]  # a character outside the vocabulary stands alone
                for start in range(max(0, end - longest), end):
                    t = reachable.get(word[start:end])
                    if t is not None and (start == 0 or together(last[start], t)):
                        piece = t
                        break
                last.append(piece)
            before = word
            parts, at = [], len(word)
            while at:
                parts.append(last[at])
                at -= len(last[at])
            parts.reverse()
            out[word] = self._ids(parts)
        return out

    def _chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of new chunks: cut into words, all distinct words in one walk."""
        cut = [self.cut.findall(c.decode().replace(" ", MARK)) for c in chunks]
        words = self._walk(sorted(set().union(*cut)))
        return [b"".join(map(words.__getitem__, c)) for c in cut]

    def encode_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); a mark precedes every text."""
        return self.encode([b" " + t if t else t for t in texts])

    def decode_texts(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of ids that lie in a row (``counts`` of each text), as UTF-8: one gather from the pieces' bytes."""
        each = self.size[ids]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        data = self.bytes[np.repeat(self.offset[ids] - (ends - each), each) + np.arange(total)].tobytes()
        cuts = np.r_[0, ends][np.r_[0, np.cumsum(counts)]].tolist()
        return [data[a:b].removeprefix(b" ") for a, b in zip(cuts[:-1], cuts[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, as UTF-8."""
        return self.decode_texts(ids, np.asarray([len(ids)]))[0]


def codec(model: str) -> Codec:
    """The codec of a model file, once per Python worker."""
    hold(_state)
    if _state.get("model") != model:
        _state.update(model=model, codec=Codec(model))
    return _state["codec"]


def encode_documents(docs: DataFrame, model: str, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``docs`` plus ``piece_ids`` (array<int>), ``n_pieces``, ``ids_crc32`` and ``decoded_equal``
    (the decoded ids give the text back; false only where the text holds the mark), and
    ``decoded_text`` if asked for. Columns of these names in ``docs`` are replaced."""
    added = ["piece_ids", "n_pieces", "ids_crc32", "decoded_equal"] + (["decoded_text"] if with_text else [])
    src = docs.drop(*added)
    text_at, names = src.columns.index(text_col), [*src.columns, *added]
    kinds = {"piece_ids": "array<int>", "n_pieces": "long", "ids_crc32": "long", "decoded_equal": "boolean",
             "decoded_text": "string"}
    out = src
    for name in added:
        out = out.withColumn(name, F.lit(None).cast(kinds[name]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for start, texts in text_groups(batch.column(text_at)):
                ids, counts = c.encode_texts(texts)
                ends = np.cumsum(counts)
                arrays = np.split(ids, ends[:-1])
                back = c.decode_texts(ids, counts)
                new = {"piece_ids": pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.view("<i4"))),
                       "n_pieces": pa.array(counts),
                       "ids_crc32": pa.array([zlib.crc32(a) for a in arrays], pa.int64()),
                       "decoded_equal": pa.array([a == b for a, b in zip(texts, back)]),
                       "decoded_text": pa.array([b.decode("utf-8", "replace") for b in back], pa.string()) if with_text else None}
                kept = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*kept.columns, *(new[n] for n in added)], names=names)

    return src.mapInArrow(run, out.schema)


def model_path(model: str | None = None) -> str:
    if model is None:
        import public_tokenizers
        model = public_tokenizers.path("piece_bpe_32k.model")
    return model


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Encode and decode every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_documents(docs, model_path(model))
    return coded.select("doc_id", "n_pieces", "ids_crc32", "decoded_equal")
