"""Token ids of whole texts by the tokenizers library, with words encoded once per worker.

The vocabulary's splitting pattern never joins what stands before a single space with
what follows it, so the part from one space to the next has ids of its own. Ids of such
parts are kept in the worker; only parts not met before go through the library. Texts
with other white space beside a space go through it whole.
"""

from __future__ import annotations

import os
from functools import lru_cache
from string import punctuation

import numpy as np

ID = np.dtype("<u4")
#: Parts longer than this are not kept, and so many parts are kept before starting anew.
LONGEST_KEPT, MOST_KEPT = 64, 1_500_000
#: Characters of texts that are split at once, and parts that go through the library in one text.
_AT_ONCE, _JOINED = 3_000_000, 64


class PartwiseEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit integers.

    Subclasses give ``_ids`` of whole texts and ``_learn`` the ids of parts, each with a
    space before it.
    """

    def __init__(self):
        self._parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= _AT_ONCE:
                out += self._encode_some(some)
                some, size = [], 0
        return out + self._encode_some(some)

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") for t in texts]
        new: set[str] = set()
        for parts in split:
            new.update(parts[1:])
        # Not in place: that would go through all known parts, not the new ones.
        new = new.difference(self._parts)
        odd = {p for p in new if not p or p[0].isspace()}
        learnt = self._learn(list(new - odd))
        if len(self._parts) + len(learnt) > MOST_KEPT:
            for parts in split:
                learnt.update((p, self._parts[p]) for p in parts[1:] if p in self._parts)
            self._parts = {}
        known, long = self._parts, {}
        for part, ids in learnt.items():
            (known if len(part) <= LONGEST_KEPT else long)[part] = ids
        heads = iter(self._ids([parts[0] for parts in split]))
        out: list[bytes] = []
        for text, parts in zip(texts, split, strict=True):
            head = next(heads).tobytes()
            try:
                out.append(head + b"".join(map(known.__getitem__, parts[1:])))
            except KeyError:
                if odd and not odd.isdisjoint(parts[1:]):
                    out.append(self._ids([text])[0].tobytes())
                else:
                    out.append(head + b"".join([known.get(p) or long[p] for p in parts[1:]]))
        return out


class TextEncoder(PartwiseEncoder):
    """Ids by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._opens = np.zeros(self.size, dtype=bool)
        for token, number in self._tokenizer.get_vocab(with_added_tokens=True).items():
            self._opens[number] = token.startswith("Ġ")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=ID) for e in found]

    def _alone(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts, each with a space before it. Many go in one text: a token that
        opens with a space opens a part."""
        out: dict[str, bytes] = {}
        groups = [parts[i : i + _JOINED] for i in range(0, len(parts), _JOINED)]
        for group, ids in zip(groups, self._ids(["".join(" " + p for p in g) for g in groups]), strict=True):
            starts = np.flatnonzero(self._opens[ids])
            data, bounds = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            if len(starts) != len(group):
                raise ValueError("the vocabulary does not split texts at single spaces")
            out.update((p, data[a:b]) for p, a, b in zip(group, bounds, bounds[1:], strict=False))
        return out

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """The pattern also splits punctuation from a letter or number before it, so a word
        that is known without its punctuation is not encoded again."""
        ended: dict[str, tuple[str, str]] = {}
        joined = " ".join(parts)
        special = [s for s in self._special if s in joined]
        for part in parts:
            word = part.rstrip(punctuation)
            if word and len(word) < len(part) and word[-1].isalnum() and not (special and any(s in part for s in special)):
                ended[part] = word, part[len(word) :]
        words = {w for w, _ in ended.values()}
        words.update(p for p in parts if p not in ended)
        out = self._alone(list(words.difference(self._parts)))
        signs = list({s for _, s in ended.values()})
        ids_of = dict(zip(signs, map(np.ndarray.tobytes, self._ids(signs)), strict=True))
        known = self._parts
        out.update({part: (out.get(word) or known[word]) + ids_of[sign] for part, (word, sign) in ended.items()})
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder for each vocabulary file and Python worker."""
    return TextEncoder(path)
