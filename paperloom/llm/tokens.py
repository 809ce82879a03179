"""Token ids of whole texts, by a tokenizer file of the tokenizers library.

A byte-level BPE vocabulary splits a text before any white space that follows
something else, so the pieces between can be encoded on their own. Most pieces
of a corpus are frequent words: each worker process keeps their ids and hands
only new pieces to the tokenizer, many at a time.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces a worker remembers, in two generations; some 150 MB at most.
REMEMBERED = 700_000
_MARK = "\x01"
# White space before a space or line end, or the mark itself: such texts are encoded uncut.
_UNCUT = ("[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}][ \\n]"
          "|\\x01")


class Encoder:
    """``encode(texts)`` gives the ids of many texts.

    Special tokens' strings in a text are ordinary text. Null counts as empty.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        config = json.loads(self.tokenizer.to_str())
        before = config.get("pre_tokenizer") or {}
        self.cuts = (config.get("normalizer") is None and before.get("type") == "ByteLevel"
                     and before.get("use_regex", True) and not before.get("add_prefix_space", True))
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.widths = np.zeros(self.vocabulary, "<i8")  # bytes of each id: a character of a token stands for a byte
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        self.limit = remembered // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that begin with white space as one text and cut it where a piece's bytes end."""
        text = "".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(p) for p in pieces] if text.isascii() else [len(p.encode()) for p in pieces])
        cuts = (np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1).tolist()
        data, at = ids.tobytes(), 0
        for piece, cut in zip(pieces, cuts):
            self.young[piece] = data[4 * at:4 * cut]
            at = cut

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, pieces))
        new = [p for p, ids in zip(pieces, found) if ids is None]
        if not new:
            return found
        joined, alone = [], []
        for p in new:
            ids = self.old.get(p)
            if ids is not None:
                self.young[p] = ids
            elif len(p) > 1 and p[0] in " \n":
                joined.append(p)
            else:
                alone.append(p)
        self.young.update(zip(alone, self.whole(alone)))
        for start in range(0, len(joined), 20_000):
            self._learn(joined[start:start + 20_000])
        return [self.young[p] if ids is None else ids for p, ids in zip(pieces, found)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and where each text begins (and the last ends)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        uncut = pc.match_substring_regex(texts, _UNCUT).to_numpy(zero_copy_only=False)
        if not self.cuts:
            uncut = np.ones(len(texts), bool)
        marked = pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", _MARK + "\n")
        if uncut.any():
            marked = pc.if_else(pa.array(uncut), pa.scalar("", pa.large_string()), marked)
        lists = pc.split_pattern(marked, _MARK)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        distinct = self._known(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy()
        sizes = np.array([len(x) for x in distinct], np.int64) // 4
        store = np.frombuffer(b"".join(distinct), "<u4")
        starts = np.cumsum(sizes) - sizes
        each = sizes[index]
        ends = np.cumsum(each)
        ids = store[np.repeat(starts[index] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
        at = np.concatenate([[0], ends])[bounds - bounds[0]]
        if uncut.any():
            pieces = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            rows = np.flatnonzero(uncut).tolist()
            for row, data in zip(rows, self.whole([texts[row].as_py() for row in rows])):
                pieces[row] = np.frombuffer(data, "<u4")
            at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
            ids = np.concatenate(pieces)
        return ids, at


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def public_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
