"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once per worker.

A byte-level BPE with the usual splitting rule never lets a token span the place between a non-space character and a
single space, or line end, that another non-space character follows, nor the place between an ASCII letter or digit
and a full stop or comma that ends a word. So a text is cut there, the ids of each distinct piece are kept, and pieces
are told apart by a hash and then by all their bytes. Texts with runs of white space, where the rule does not hold,
are encoded whole. Either way the ids are those of ``encode(text, add_special_tokens=False)``, with strings of
special tokens as plain text.
"""

from __future__ import annotations

import json
import os
import sys
import types

import numpy as np

from voxgauge.llm.arrow_text import WORKER_STORE, WordHasher, spread

#: Distinct pieces whose ids one worker keeps (about 100 bytes each); then it starts anew. Never changes ids.
KEPT_PIECES = 500_000
#: Pieces joined into one call of the tokenizer.
JOINED = 200

_ASCII_ALNUM = np.zeros(256, bool)
_ASCII_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self._by_pieces = (
            spec.get("normalizer") is None
            and spec["model"].get("type") == "BPE"
            and not spec["model"].get("dropout")
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
        )
        vocabulary = self.tokenizer.get_vocab()
        self._token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self._token_bytes[i] = len(token)  # one character of the byte alphabet per byte
        self._hasher = WordHasher(seed=5, lower=False)
        self._clear()

    def _clear(self) -> None:
        self._hashes, self._number = np.empty(0, np.uint64), np.empty(0, np.int64)  # in order of the hashes
        self._text = np.empty(0, np.uint8)  # by number from here on
        self._text_at, self._text_size = np.empty(0, np.int64), np.empty(0, np.int64)
        self._ids = np.empty(0, np.uint32)
        self._ids_at, self._ids_size = np.empty(0, np.int64), np.empty(0, np.int64)  # -1: not to be encoded alone

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in done]

    def _joined(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of pieces that start with the same white-space byte, and how many of them each piece has."""
        sizes = []
        texts = ["".join(pieces[i : i + JOINED]) for i in range(0, len(pieces), JOINED)]
        all_ids = self._whole(texts)
        for text, ids in zip(texts, all_ids):
            data = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(data == data[0])[1:], len(data))
            sizes.append(np.diff(np.searchsorted(np.cumsum(self._token_bytes[ids]), ends) + 1, prepend=0))
        return all_ids, sizes

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Keeps new pieces: ``hashes`` in ascending order, each with the bytes of one place where it stands."""
        size = ends - starts
        text = data[spread(starts, size)]
        cut = np.cumsum(size)
        whole = text.tobytes()
        pieces = [whole[a:b].decode() for a, b in zip((cut - size).tolist(), cut.tolist())]
        kinds: dict[str, list[int]] = {" ": [], "\n": [], "": []}
        for i, p in enumerate(pieces):
            mark = p[0] if p[0] in " \n" else ""
            body = p[1:] if mark else p
            if body and not (body[0].isspace() or body[-1].isspace()):
                kinds[mark].append(i)
        at, n_ids = np.full(len(pieces), -1), np.zeros(len(pieces), np.int64)
        flat, top = [self._ids], len(self._ids)
        for mark, chosen in kinds.items():
            if chosen:
                some = [pieces[i] for i in chosen]
                if mark:
                    ids, counts = self._joined(some)
                else:
                    ids = self._whole(some)
                    counts = [np.array([len(x) for x in ids])]
                n_ids[chosen] = np.concatenate(counts)
                at[chosen] = top + np.cumsum(n_ids[chosen]) - n_ids[chosen]
                flat += ids
                top += int(n_ids[chosen].sum())
        place = np.searchsorted(self._hashes, hashes)
        self._number = np.insert(self._number, place, len(self._ids_at) + np.arange(len(hashes)))
        self._hashes = np.insert(self._hashes, place, hashes)
        self._text_at = np.concatenate([self._text_at, len(self._text) + cut - size])
        self._text_size = np.concatenate([self._text_size, size])
        self._text = np.concatenate([self._text, text])
        self._ids_at, self._ids_size = np.concatenate([self._ids_at, at]), np.concatenate([self._ids_size, n_ids])
        self._ids = np.concatenate(flat)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts whose UTF-8 bytes lie between ``offsets``, in a row, and where each text's ids begin."""
        n, total = len(offsets) - 1, len(data)
        if not total:
            return np.empty(0, np.uint32), np.zeros(n + 1, np.int64)
        if not self._by_pieces:
            return self._splice(data, offsets, np.ones(n, bool), np.empty(0, np.uint32), np.zeros(n + 1, np.int64))
        edge = np.zeros(total + 1, bool)
        edge[offsets] = True
        space = (data == 32) | (data == 10)
        begins = edge[:-1] | space
        closes = np.append(space, True) | edge
        stop = np.flatnonzero(((data == 46) | (data == 44)) & closes[1:])
        stop = stop[(stop > 0) & _ASCII_ALNUM[data[stop - 1]] & ~edge[stop]]
        begins[stop] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], total)
        first = np.searchsorted(starts, offsets)
        hashes, where, which = np.unique(self._hasher(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._hashes) > KEPT_PIECES:
            self._clear()
        place = np.searchsorted(self._hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self._hashes)
        new[inside] = self._hashes[place[inside]] != hashes[inside]
        if new.any():
            self._learn(hashes[new], data, starts[where[new]], ends[where[new]])
            place = np.searchsorted(self._hashes, hashes)
        number = self._number[place][which]
        size, at = self._ids_size[number], self._ids_at[number]
        bad = (self._text_size[number] != ends - starts) | (at < 0)
        same = self._text[np.minimum(spread(self._text_at[number], ends - starts), len(self._text) - 1)] == data
        bad |= ~np.logical_and.reduceat(same, starts)
        bounds = np.concatenate([[0], np.cumsum(size)])[first]
        flat = self._ids[spread(np.maximum(at, 0), size)]
        odd = np.diff(np.concatenate([[0], np.cumsum(bad)])[first]) > 0
        return self._splice(data, offsets, odd, flat, bounds) if odd.any() else (flat, bounds)

    def _splice(self, data, offsets, odd, flat, bounds) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the ``odd`` texts found whole, the others as given."""
        rows = np.flatnonzero(odd)
        found = dict(zip(rows, self._whole([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in rows])))
        parts = [found[i] if i in found else flat[bounds[i] : bounds[i + 1]] for i in range(len(odd))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, kept from task to task."""
    store = sys.modules.setdefault(WORKER_STORE, types.ModuleType(WORKER_STORE))
    kept = store.__dict__.setdefault("encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def default_tokenizer() -> str:
    """Place of the public byte-level BPE with 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
