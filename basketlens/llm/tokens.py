"""Token ids of whole texts by a public tokenizer file, fast.

A single space between two non-space characters always starts a new
pre-token of the byte-level tokenizer, so a text can be encoded chunk by
chunk there.  Arrow cuts and numbers the chunks of many texts at once; each
new chunk is encoded by the library once per worker, many to a call, and the
ids of a text are gathered with numpy.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker remembers before it starts afresh, and bytes of them
#: for each; some 200 bytes of memory a chunk.
REMEMBERED_CHUNKS, BYTES_EACH = 700_000, 20
#: Bytes of text that are gathered at once, and new chunks encoded in one call.
GROUP_BYTES, JOINED = 4_000_000, 2_000

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class _Numbers(dict):
    """Numbers new keys in order and remembers which are new."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.new.append(key)
        return number

    def of(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class TextEncoder:
    """Ids of texts by the tokenizer file at ``path``, as the library loads
    it; ``end_id`` is put behind each text.  A text that holds one of the
    file's added tokens goes to the library whole."""

    def __init__(self, path: str, end_id: int | None, remembered: int = REMEMBERED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        #: Which ids start with the letter that stands for a space.
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.end_id, self.remembered = end_id, remembered
        self._forget()

    def _forget(self):
        self.numbers = _Numbers()
        self.ids = np.empty(0, np.uint32)
        self.sizes = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.unsafe = np.empty(0, bool)
        self.bytes = 0

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many of each text."""
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.empty(0, np.uint32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded``, of chunks behind a space each, without spaces:
        joined, as the only ids with a space are those that start a chunk."""
        ids, _ = self._encoded(["".join(" " + w for w in words[i : i + JOINED]) for i in range(0, len(words), JOINED)])
        firsts = np.flatnonzero(self.spaced[ids])
        if len(firsts) != len(words) or (len(firsts) and firsts[0]):
            return self._encoded([" " + w for w in words])
        return ids, np.diff(firsts, append=len(ids))

    def _learn(self):
        """Encode the chunks met for the first time.  A key is the text
        behind a space, the first chunk of a document in a tuple, or None
        for its end."""
        keys, self.numbers.new = self.numbers.new, []
        if not keys:
            return
        # Most keys are chunks without spaces at their ends.
        plain = pa.array([k if isinstance(k, str) else "" for k in keys], pa.string())
        apart = pc.or_(pc.not_equal(plain, pc.utf8_trim_whitespace(plain)), pc.equal(plain, "")).to_numpy(zero_copy_only=False)
        odd = apart & np.array([isinstance(k, str) for k in keys])
        apart |= pc.match_substring(plain, " ").to_numpy(zero_copy_only=False)
        words, others = np.flatnonzero(~apart), np.flatnonzero(apart)
        texts = [" " + k if isinstance(k, str) else "" if k is None else k[0] for k in (keys[i] for i in others.tolist())]
        sizes, base = np.zeros(len(keys), np.int64), len(self.ids)
        word_ids, sizes[words] = self._encoded_words([keys[i] for i in words.tolist()])
        other_ids, sizes[others] = self._encoded(texts)
        starts = np.zeros(len(keys), np.int64)
        starts[words] = base + np.cumsum(sizes[words]) - sizes[words]
        starts[others] = base + len(word_ids) + np.cumsum(sizes[others]) - sizes[others]
        ids = [self.ids, word_ids, other_ids]
        if self.end_id is not None and None in self.numbers and self.numbers[None] >= len(self.sizes):
            at = self.numbers[None] - len(self.sizes)
            sizes[at], starts[at] = 1, base + len(word_ids) + len(other_ids)
            ids.append(np.array([self.end_id], np.uint32))
        self.ids = np.concatenate(ids)
        self.sizes, self.starts, self.unsafe = (np.concatenate(x) for x in ((self.sizes, sizes), (self.starts, starts), (self.unsafe, odd)))
        self.bytes += sum(map(len, texts)) + (pc.sum(pc.binary_length(plain)).as_py() or 0)

    def _encode_group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.numbers) > self.remembered or self.bytes > BYTES_EACH * self.remembered:
            self._forget()
        lists = pc.split_pattern(texts, " ")
        many = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, firsts = lists.flatten(), np.cumsum(many) - many
        coded = flat.dictionary_encode()
        numbers = self.numbers.of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        numbers[firsts] = self.numbers.of([(c,) for c in flat.take(pa.array(firsts)).to_pylist()])
        numbers = np.insert(numbers, firsts + many, self.numbers[None])
        firsts = firsts + np.arange(len(firsts))
        self._learn()
        odd = np.logical_or.reduceat(self.unsafe[numbers], firsts)
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if (odd | whole).any():
            cut = np.split(numbers, firsts[1:])
            for i in np.flatnonzero(odd | whole).tolist():
                text = texts[i].as_py()
                chunks = [text] if whole[i] else _SAFE_SPACE.split(text)
                cut[i] = self.numbers.of([(chunks[0],), *chunks[1:], None])
            self._learn()
            many = np.fromiter(map(len, cut), np.int64, len(cut))
            numbers, firsts = np.concatenate(cut), np.cumsum(many) - many
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.ids[at], np.add.reduceat(sizes, firsts)

    def encode(self, texts: pa.Array | Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per group of texts, in order: all ids, and ids per text.  Null
        texts are empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(list(texts), pa.string())
        texts = pc.fill_null(texts, "")
        group = min(GROUP_BYTES, 8 * self.remembered)
        number = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // group
        edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield self._encode_group(texts.slice(start, end - start))


_encoders: dict[tuple, TextEncoder] = {}


def encoder(path: str, end_id: int | None, remembered: int = REMEMBERED_CHUNKS) -> TextEncoder:
    """The worker's encoder, kept between tasks."""
    key = (path, end_id, remembered)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(*key)
    return _encoders[key]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
