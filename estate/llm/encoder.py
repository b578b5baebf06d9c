"""Token ids of texts by a tokenizer none of whose tokens spans white space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from estate.llm.words import Memo, Words, ragged

#: words in a text for the tokenizer, which has a high cost per text, and words given to it at once: what it returns
#: is some hundred times the ids
_JOINED, _CALL = 32, 4096


class WordEncoder:
    """Ids by word: each distinct word is encoded once as long as the memo holds it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo = Memo(np.uint32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids one after the other.

        Words are joined by spaces; where a token starts tells its word.
        """
        texts = [" ".join(words[i : i + _JOINED]) for i in range(0, len(words), _JOINED)]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        sizes = np.fromiter((len(e) for e in found), np.int64, len(found))
        n = int(sizes.sum())
        before = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        place = np.fromiter((o[0] for e in found for o in e.offsets), np.int64, n) + np.repeat(before, sizes)
        ends = np.cumsum([len(w) + 1 for w in words])
        counts = np.bincount(np.searchsorted(ends, place, side="right"), minlength=len(words))
        return counts, np.fromiter((i for e in found for i in e.ids), np.uint32, n)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number before each text."""
        words = Words(texts)
        unique, where, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if self.memo.full():
            self.memo.clear()
        new = np.flatnonzero(self.memo.missing(unique))
        if len(new):
            lengths, values = [], []
            strings = words.array()
            for at in range(0, len(new), _CALL):
                chosen = strings.take(pa.array(where[new[at : at + _CALL]])).to_pylist()
                counts, found = self._encode(chosen)
                lengths.append(counts)
                values.append(found)
            self.memo.add(unique[new], np.concatenate(lengths), np.concatenate(values))
        starts, lengths = (x[back] for x in self.memo.find(unique))
        ends = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, dtype=np.int64, out=ends[1:])
        return self.memo.values[ragged(starts, lengths)], ends[words.first]
