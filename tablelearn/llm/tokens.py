"""Token ids of whole texts with the word-end BPE vocabulary, word by word.

The tokenizer lower-cases, drops white space and never joins characters across it, so a
text's ids are the ids of its space-separated words in order. Each worker keeps the ids of
the words it has met."""

from __future__ import annotations

import re

import numpy as np

from tablelearn.llm.common import worker_cache

VOCABULARY_FILE = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_SIGNS = re.compile(rb"(?<=[a-z0-9])[!-&(-/:-@\[-`{-~]+(?=[\x20\x09-\x0D])")
_PLAIN = re.compile(rb"[a-z]+").fullmatch


def _words(text: str) -> list[bytes]:
    """Space-separated words. ASCII signs (but the apostrophe) between a letter or digit and white
    space are split from the word by the tokenizer, and capitals do not matter: both are evened
    out here, which spares most new words. Texts
    with special tokens or combining marks (which may belong to a capital) stay as they are."""
    data = text.encode("utf-8", "replace")
    if b"<|" not in data and b"\xcc" not in data and b"\xcd" not in data:
        data = _SIGNS.sub(rb" \g<0>", data.lower())
    return data.split()


class _WordIds(dict):
    """``word (bytes) -> its ids as little-endian 32-bit numbers``, emptied at ``limit`` words."""

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        super().__init__()
        self.limit = limit
        self.tokenizer = Tokenizer.from_file(path)
        # Words of a-z only need neither normalising nor splitting.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for w, k in vocabulary.items() if w.endswith("</w>")]] = True

    def _one(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str], tokenizer) -> list[bytes]:
        """Ids of words of letters only, encoded as one text: each ends with an end-of-word id."""
        ids = np.asarray(tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or (len(ids) and cuts[-1] != len(ids)):
            return [self._one(w) for w in words]
        raw, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return [raw[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]

    def learn(self, words: set[bytes]) -> None:
        """Make sure that all of ``words`` have entries."""
        if len(self) + len(words) > self.limit:
            self.clear()
        plain, letters = [], []
        for word in words:
            if word in self:
                continue
            if _PLAIN(word):
                plain.append(word)
                continue
            text = word.decode("utf-8", "replace")
            if text.isalpha() and text.lower().isalpha():
                letters.append(word)
            else:
                self[word] = self._one(text)
        for some, tokenizer in ((plain, self.plain), (letters, self.tokenizer)):
            for k in range(0, len(some), 1000):
                part = some[k : k + 1000]
                self.update(zip(part, self._together([w.decode() for w in part], tokenizer), strict=True))


def token_bytes(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of whole texts, 4 little-endian bytes each id."""
    ids = worker_cache("word_ids_" + path, lambda: _WordIds(path))
    words = [_words(t or "") for t in texts]
    ids.learn(set().union(*words))
    return [b"".join(map(ids.__getitem__, w)) for w in words]
