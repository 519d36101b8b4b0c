"""Encoding whole texts by their words: what the encoders share.

White space ends every piece of the tokenizers used here and leaves none itself, so the ids of a text
are those of its white-space separated words in turn. Most words are one run of letters, perhaps with
marks behind; each distinct run is encoded once for a block of documents and remembered for the next, and
so are the marks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import itemgetter
from unicodedata import is_normalized

import regex

#: Fixed value: white space as the tokenizer's patterns understand it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What str.split() takes for white space beyond that.
_ODD, _WHITE = regex.compile(r"[\x1c-\x1f]"), regex.compile(f"[{SPACE}]+")
#: Signs that are one piece of their own behind letters. An apostrophe may take letters along, so it is left out.
_MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
#: Words remembered by a worker (a few hundred bytes each), and characters handled at once.
HELD_WORDS, BLOCK_CHARS = 500_000, 4_000_000

Learn = Callable[[list[str]], list[bytes]]


def letters_only(word: str) -> bool:
    """Whether the tokenizer keeps the word in one piece: letters, and still letters in its own form."""
    return word.isalpha() and (word.isascii() or (is_normalized("NFC", word) and word.lower().isalpha()))


class TextEncoder:
    """Encodes texts; ``runs`` encodes runs of letters, ``others`` any other words."""

    def __init__(self, runs: Learn, others: Learn, held: int = HELD_WORDS, block_chars: int = BLOCK_CHARS):
        self.runs, self.others, self.held, self.block_chars = runs, others, held, block_chars
        self.words: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> None:
        known, plain, tails, marked, odd = self.words, set(), set(), [], []
        for w in new:
            core = w.rstrip(_MARKS)
            if not letters_only(core):
                odd.append(w)
                continue
            plain.add(core)
            if len(core) < len(w):
                marked.append(w)
                tails.add(w[len(core):])
        run = list(plain.difference(known))
        odd.extend(tails.difference(known, odd))
        known.update(zip(run, self.runs(run)))
        known.update(zip(odd, self.others(odd)))
        for w in marked:
            core = w.rstrip(_MARKS)
            known[w] = known[core] + known[w[len(core):]]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as the encoders' bytes."""
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= self.block_chars):
                chars += len(texts[stop])
                stop += 1
            block = [t.split() if not _ODD.search(t) else [w for w in _WHITE.split(t) if w] for t in texts[at:stop]]
            if len(self.words) > self.held:
                self.words.clear()
            self._learn(set().union(*block).difference(self.words))
            for words in block:
                # one call for all words of a text is faster than one for each
                yield b"".join(itemgetter(*words)(self.words) if len(words) > 1 else map(self.words.__getitem__, words))
            at = stop
