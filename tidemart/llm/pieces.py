"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut where no piece of the vocabulary can reach across (before a run of word marks, around
a line end); the parts are the words of the merge rounds. All words of a block that are not known
yet stand in one flat symbol array. Each round finds the lowest pair rank of every word with one
segmented minimum, merges its leftmost occurrences in all words at once and compacts the array;
words without a pair left are done. Merging several occurrences of a word in one round equals
merging one after the other unless the new piece could form a pair that ranks as high; for
such pieces only the leftmost occurrence is merged.

Defined results: a null or empty text has no ids; characters outside the vocabulary become their
UTF-8 bytes; repeated rows give repeated results; columns other than the id and the text are not
looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.batches import blocks, texts_of

_MARK = "▁"
_NO_PAIR = np.iinfo(np.int32).max
# Known words kept by a worker; beyond that it starts anew after the block.
_KNOWN_WORDS = 300_000


class PieceCoder:
    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        vocabulary = SentencePieceProcessor(model_proto=model)
        size = vocabulary.get_piece_size()
        self.size = size
        special = {vocabulary.unk_id(), vocabulary.bos_id(), vocabulary.eos_id()}
        pieces = [vocabulary.id_to_piece(i) for i in range(size)]
        is_byte = [vocabulary.is_byte(i) for i in range(size)]
        ids = {
            piece: i
            for i, piece in enumerate(pieces)
            if not is_byte[i] and i not in special and not vocabulary.is_control(i)
        }
        self.byte_ids = [vocabulary.piece_to_id(f"<0x{value:02X}>") for value in range(256)]
        self.surface = [
            bytes([int(piece[3:5], 16)])
            if is_byte[i]
            else (b"" if vocabulary.is_control(i) else piece.replace(_MARK, " ").encode())
            for i, piece in enumerate(pieces)
        ]
        self.surface_text = [surface.decode("utf-8", "replace") for surface in self.surface]
        self.is_byte = np.array(is_byte, np.int64)
        self.id_text = [str(i) for i in range(size)]
        # Characters that occur in pieces without being one get symbols past the vocabulary.
        symbols = dict(ids)
        for piece in ids:
            for char in piece:
                symbols.setdefault(char, size + len(symbols))
        self.top = size + len(symbols) + 1
        self.char_symbol = np.full(0x110000, -1, np.int64)
        for symbol, number in symbols.items():
            if len(symbol) == 1:
                self.char_symbol[ord(symbol)] = number
        scores = np.array([vocabulary.get_score(i) for i in ids.values()])
        order = np.unique(-scores, return_inverse=True)[1]
        rank_of = dict(zip(ids, order.tolist(), strict=True))
        pairs: dict[int, tuple[int, int]] = {}
        unsafe = set()
        for piece, number in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.top + right] = (rank_of[piece], number)
                    unsafe.update(
                        part
                        for part in (piece[:cut], piece[cut:])
                        if part in rank_of and len(part) > 1 and rank_of[piece] <= rank_of[part]
                    )
        keys = sorted(pairs)
        self.pair_keys = np.array([*keys, np.iinfo(np.int64).max], np.int64)
        self.pair_rank = np.array([*(pairs[key][0] for key in keys), _NO_PAIR], np.int32)
        self.pair_piece = np.array([*(pairs[key][1] for key in keys), -1], np.int64)
        self.unsafe = np.zeros(self.top + 1, bool)
        self.unsafe[[ids[piece] for piece in unsafe]] = True
        reaching = {char for piece in ids if len(piece) > 1 for char in piece}
        # No piece may continue after a letter with a word mark, or the cuts would be wrong.
        if any(re.search(f"[^{_MARK}]{_MARK}", piece) for piece in ids):
            raise ValueError("pieces that reach across words are not supported")
        self.line_ends_stand_alone = "\n" not in reaching
        self.known: dict[str, tuple[str, str]] = {}

    def _pairs_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place in the pair table, or the last place where two symbols form no piece."""
        keys = np.where((left < 0) | (right < 0), -1, left * self.top + right)
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, at, len(self.pair_keys) - 1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the n + 1 offsets of the words; a word holds its marks itself."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(word) for word in words], np.int64)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        # Unknown characters are kept as -2 - code point.
        symbols = self.char_symbol[flat]
        symbols = np.where(symbols < 0, -2 - flat.astype(np.int64), symbols)
        word = np.repeat(np.arange(len(words)), lengths)
        last = np.r_[word[1:] != word[:-1], True]
        pair = np.full(len(symbols), len(self.pair_keys) - 1, np.int64)
        inner = np.flatnonzero(~last)
        pair[inner] = self._pairs_at(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            rank = self.pair_rank[pair]
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == _NO_PAIR
            if done.any():
                stay = np.repeat(~done, sizes)
                finished.append((word[~stay], symbols[~stay]))
                symbols, word, pair, rank = symbols[stay], word[stay], pair[stay], rank[stay]
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbols):
                    break
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # Of hits that overlap (aaa), every other one from the left.
            run = np.r_[True, hit[1:] != hit[:-1] + 1]
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            piece = self.pair_piece[pair[hit]]
            risky = self.unsafe[piece]
            if risky.any():
                first = np.r_[True, word[hit][1:] != word[hit][:-1]]
                group = np.cumsum(first) - 1
                single = np.zeros(group[-1] + 1, bool)
                np.logical_or.at(single, group, risky)
                use = first | ~single[group]
                hit, piece = hit[use], piece[use]
            symbols[hit] = piece
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            merged = place[hit]
            symbols, word, pair = symbols[keep], word[keep], pair[keep]
            touched = np.zeros(len(symbols), bool)
            touched[merged] = True
            touched[np.maximum(merged - 1, 0)] = True
            changed = np.flatnonzero(touched)
            after = np.minimum(changed + 1, len(symbols) - 1)
            joined = (after > changed) & (word[after] == word[changed])
            fresh = self._pairs_at(symbols[changed], symbols[after])
            pair[changed] = np.where(joined, fresh, len(self.pair_keys) - 1)
        word, symbols = (np.concatenate(column) for column in zip(*finished, strict=True))
        order = np.argsort(word, kind="stable")
        return self._with_bytes(word[order], symbols[order], len(words))

    def _with_bytes(self, word: np.ndarray, symbols: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Replace symbols that are no pieces by the ids of their bytes."""
        unknown = np.flatnonzero((symbols < 0) | (symbols >= self.size))
        spelled = [self._spelling(symbol) for symbol in symbols[unknown].tolist()]
        width = np.ones(len(symbols), np.int64)
        width[unknown] = [len(ids) for ids in spelled]
        ids, word = np.repeat(symbols, width), np.repeat(word, width)
        first = (np.cumsum(width) - width)[unknown]
        for at, spelling in zip(first.tolist(), spelled, strict=True):
            ids[at : at + len(spelling)] = spelling
        return ids, np.r_[0, np.cumsum(np.bincount(word, minlength=count))]

    def _spelling(self, symbol: int) -> list[int]:
        code = -2 - symbol if symbol < 0 else int(np.flatnonzero(self.char_symbol == symbol)[0])
        return [self.byte_ids[value] for value in chr(code).encode()]

    def decode(self, ids) -> str:
        """Text of ids; bytes that form no character become U+FFFD, one mark in front goes."""
        text = self._joined(ids)
        return text[1:] if text.startswith(" ") else text

    def _joined(self, ids) -> str:
        return b"".join([self.surface[i] for i in ids]).decode("utf-8", "replace")

    def words_of(self, text: str) -> list[str]:
        """The parts of a text that are merged independently; their sequence is the whole text."""
        if not text:
            return []
        text = _MARK + text.replace(" ", _MARK)
        lines = text.split("\n") if self.line_ends_stand_alone else [text]
        words: list[str] = []
        for number, line in enumerate(lines):
            if number:
                words.append("\n")
            if not line:
                continue
            if _MARK + _MARK in line:
                words.extend(re.findall(f"{_MARK}+[^{_MARK}]*|[^{_MARK}]+", line))
                continue
            parts = line.split(_MARK)
            if parts[0]:
                words.append(parts[0])
            words.extend([_MARK + part for part in parts[1:]])
        return words

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet: their ids as text, and what these decode to."""
        new = [word for word in words if word not in self.known]
        ids, offsets = self.encode_words(new)
        spelled = np.r_[0, np.cumsum(self.is_byte[ids])][offsets]
        ids, offsets = ids.tolist(), offsets.tolist()
        numbers, texts = [self.id_text[i] for i in ids], [self.surface_text[i] for i in ids]
        for word, low, high, bytes_ in zip(new, offsets, offsets[1:], np.diff(spelled).tolist(), strict=False):
            text = self._joined(ids[low:high]) if bytes_ else "".join(texts[low:high])
            self.known[word] = (",".join(numbers[low:high]), text)

    def digests(
        self, texts: list[str], keep_ids: bool = False
    ) -> tuple[list[int], list[str], list[str], list[str], list[np.ndarray]]:
        """Number of ids, digest of the ids, digest of the decoded text, that text, and the ids if kept."""
        counts, id_digests, text_digests, decoded, kept = [], [], [], [], []
        split = [self.words_of(text) for text in texts]
        self.learn(set().union(*split))
        for words in split:
            both = [self.known[word] for word in words]
            ids = ",".join([pair[0] for pair in both])
            text = "".join([pair[1] for pair in both])
            text = text[1:] if text.startswith(" ") else text
            counts.append(ids.count(",") + 1 if ids else 0)
            id_digests.append(hashlib.sha256(ids.encode()).hexdigest())
            text_digests.append(hashlib.sha256(text.encode()).hexdigest())
            decoded.append(text)
            if keep_ids:
                kept.append(np.array(ids.split(",") if ids else [], np.int32))
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        return counts, id_digests, text_digests, decoded, kept

    def encode(self, text: str) -> list[int]:
        """All ids of one text."""
        words = self.words_of(text)
        distinct = list(dict.fromkeys(words))
        ids, offsets = self.encode_words(distinct)
        places = {word: slice(*offsets[i : i + 2].tolist()) for i, word in enumerate(distinct)}
        return [i for word in words for i in ids[places[word]].tolist()]


@lru_cache(maxsize=2)
def coder(model: bytes) -> PieceCoder:
    return PieceCoder(model)


def model_bytes(path: str) -> bytes:
    """The model file, read where the query is built; tasks get its content (about 0.5 MB)."""
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with `keep_ids` also token_ids."""
    model = model_bytes(path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", token_ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in blocks(batches):
            texts = texts_of(batch)
            counts, ids, decoded, _, kept = own.digests(texts, keep_ids)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema
    )
