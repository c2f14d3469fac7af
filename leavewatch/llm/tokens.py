"""Token ids of whole texts, each distinct chunk of text encoded once per worker.

A chunk is what lies between spaces and line feeds, in lower-case ASCII, less
a full stop or comma that ends it after an ASCII letter; that is a chunk of its
own. The tokenizer splits at all these places, drops white space and lowers
case, so a text's ids are its chunks' ids one after the other (`chunked=False`
encodes whole texts, for tokenizers where that does not hold).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from leavewatch.llm.text_arrays import FIRST, SECOND, byte_set, hashes, slices, spans, spread

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
MEMORY = 1_500_000  # chunks a worker remembers
PIECE = 2 << 20     # bytes of text encoded at once
JOINED = 500        # new chunks encoded as one text

_CHUNK = ~byte_set((32, 32), (10, 10))
_LETTER = byte_set((97, 122))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_loaded: dict[str, "Encoder"] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(count.sum())), count


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.suffixed = bool(suffix)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = self.suffixed and token.endswith(suffix)
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)    # first hash, ascending
        self.second = np.empty(0, np.uint64)   # second hash
        self.begin = np.empty(0, np.int64)     # in ids
        self.count = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat, and how many each has."""
        return flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def words(self, chunks: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks, many in one text. Plain ones are letters only: each ends with its one word."""
        texts = [" ".join(chunks[i:i + JOINED]) for i in range(0, len(chunks), JOINED)]
        if plain:
            ids, _ = self.whole(texts)
            last = np.flatnonzero(self.ends[ids])
            count = np.diff(last, prepend=-1)
            return (ids, count) if len(count) == len(chunks) else self.whole(chunks)
        ids, count = [], []
        for i, found in enumerate(self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            own = chunks[i * JOINED:(i + 1) * JOINED]
            begin = np.cumsum([0] + [len(c) + 1 for c in own[:-1]])
            place = np.searchsorted(begin, np.array([a for a, _ in found.offsets], dtype=np.int64), side="right") - 1
            ids.append(np.array(found.ids, dtype=np.uint32))
            count.append(np.bincount(place, minlength=len(own)))
        return np.concatenate(ids), np.concatenate(count)

    def learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, key: np.ndarray, check: np.ndarray) -> None:
        inside = np.concatenate([[0], np.cumsum(_LETTER[data])])
        plain = (inside[end] - inside[begin] == end - begin) & self.suffixed
        for kind in (True, False):
            of = np.flatnonzero(plain == kind)
            if not len(of):
                continue
            chunks = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(begin[of].tolist(), end[of].tolist())]
            ids, count = self.words(chunks, kind)
            place = np.searchsorted(self.known, key[of])
            self.begin = np.insert(self.begin, place, len(self.ids) + np.cumsum(count) - count)
            self.count = np.insert(self.count, place, count)
            self.second = np.insert(self.second, place, check[of])
            self.known = np.insert(self.known, place, key[of])
            self.ids = np.concatenate([self.ids, ids])

    def chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, flat, and how many each has."""
        raw = data
        if not (data == 60).any():  # "<" may begin a special token, which keeps its case
            data = _LOWER[data]
        begin, end = spans(data, offsets, _CHUNK)
        point = (end - begin > 1) & np.isin(data[end - 1], (44, 46)) & _LETTER[data[end - 2]] if len(end) else np.empty(0, bool)
        stop = end[point]
        end = end - point
        begin, end = np.concatenate([begin, stop - 1]), np.concatenate([end, stop])
        order = np.argsort(begin, kind="stable")
        begin, end = begin[order], end[order]
        key, check = hashes(data, begin, end, FIRST), hashes(data, begin, end, SECOND)
        distinct, first, place = np.unique(key, return_index=True, return_inverse=True)
        if len(self.known) > MEMORY:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        same = clash = np.zeros(len(distinct), dtype=bool)
        if len(self.known):
            same = self.known[at] == distinct
            clash = same & (self.second[at] != check[first])
        if clash.any() or (check != check[first][place]).any():  # two chunks, one hash
            return self.whole([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])])
        new = first[~same]
        if len(new):
            self.learn(data, begin[new], end[new], key[new], check[new])
            at = np.searchsorted(self.known, distinct)
        length = self.count[at][place]
        ids = self.ids[spread(self.begin[at][place], length)]
        text = np.searchsorted(offsets, begin, side="right") - 1
        return ids, np.bincount(text, weights=length, minlength=len(offsets) - 1).astype(np.int64)


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encoded(column: pa.Array, path: str, end_id: int | None = END_ID, chunked: bool = True,
            limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, ids of those rows, offsets of the rows in them).

    Each row's ids end with end_id, unless it is None. Null is an empty text.
    """
    worker = encoder(path)
    for first, last, data, offsets in slices(column, limit):
        if chunked:
            ids, count = worker.chunks(data, offsets)
        else:
            ids, count = worker.whole([data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])])
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(count), np.uint32(end_id))
            count = count + 1
        yield first, last, ids, np.concatenate([[0], np.cumsum(count)])
