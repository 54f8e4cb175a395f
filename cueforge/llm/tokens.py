"""Token ids of whole texts, from the ids of their distinct words.

The tokenizer drops white space, never joins across it, and never joins an ASCII letter with a following ASCII
character that isn't one. So texts are cut there, each distinct part is encoded once, and the ids of a text are
gathered with numpy. A worker keeps the parts that it has seen, up to a fixed number.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from cueforge.llm.words import buffers, word_spans

PIECE, KEPT, AT_ONCE, SLOT_BITS = 4 << 20, 1_200_000, 20_000, 20
_letter, _other = np.zeros(256, bool), np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True
_other[33:127] = ~_letter[33:127]
_other[ord("|")] = False  # inside the names of special tokens


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    """The tokenizer, its last special token, and which ids end a word."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    names = tok.get_vocab(with_added_tokens=True)
    ends = np.zeros(max(names.values()) + 1, bool)
    ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
    number, mark = max(tok.get_added_tokens_decoder().items())
    return tok, number, mark.content, ends


def vocabulary(path: str) -> int:
    """One more than the largest id."""
    return len(_tokenizer(path)[3])


def _one_run(word: str) -> bool:
    """True if all of it are letters, also once it is normalised: then it is a single word to the tokenizer."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def _encode_words(path: str, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words, and where each word's begin in them and how many they are."""
    tok, number, mark, ends = _tokenizer(path)
    begin, size, out, held = np.zeros(len(words), np.int64), np.zeros(len(words), np.int32), [np.zeros(0, np.uint32)], 0
    runs = np.fromiter(map(_one_run, words), bool, len(words))
    special = np.fromiter(("<|" in w for w in words), bool, len(words))
    for kind, gap in ((runs, " "), (~runs & ~special, f" {mark} ")):
        own = np.flatnonzero(kind)
        for lo in range(0, len(own), AT_ONCE):
            part = own[lo : lo + AT_ONCE]
            got = np.array(tok.encode(gap.join([words[i] for i in part.tolist()]), add_special_tokens=False).ids, np.uint32)
            if gap == " ":  # the last id of a word ends it
                stop = np.flatnonzero(ends[got]) + 1
                start = np.r_[0, stop[:-1]]
            else:
                cut = np.flatnonzero(got == number)
                start, stop = np.r_[0, cut + 1], np.r_[cut, len(got)]
            if len(start) != len(part):
                special[part] = True
                continue
            begin[part], size[part] = held + start, stop - start
            out.append(got)
            held += len(got)
    for i in np.flatnonzero(special).tolist():
        got = np.array(tok.encode(words[i], add_special_tokens=False).ids, np.uint32)
        begin[i], size[i] = held, len(got)
        out.append(got)
        held += len(got)
    return np.concatenate(out), begin, size


class _Seen:
    """The ids of words by hash; forgets all when it has more than KEPT words.

    A table of slots by the hash's highest bits finds nearly all words at once: the first word of a slot keeps it, and
    frequent words come early. Other words are searched for in sorted order.
    """

    def __init__(self) -> None:
        self.hash, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.slots, self.taken = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, bool)
        self.ordered, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in the arrays of words, and for the unknown ones among h: the distinct hashes, and where each is first."""
        if not len(self.hash):
            return np.zeros(len(h), np.int32), *np.unique(h, return_index=True)
        at = self.slots[self._slot(h)]
        miss = np.flatnonzero(self.hash[at] != h)
        own, first, which = np.unique(h[miss], return_index=True, return_inverse=True)
        near = np.minimum(np.searchsorted(self.ordered, own), len(self.ordered) - 1)
        at[miss] = self.place[near][which]
        new = self.ordered[near] != own
        return at, own[new], miss[first[new]]

    def add(self, h: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """h: ascending, none known yet."""
        place = np.arange(len(self.hash), len(self.hash) + len(h), dtype=np.int32)
        to = np.searchsorted(self.ordered, h)
        self.ordered, self.place = np.insert(self.ordered, to, h), np.insert(self.place, to, place)
        self.hash, self.at, self.size = np.r_[self.hash, h], np.r_[self.at, len(self.ids) + begin], np.r_[self.size, size]
        self.ids = np.concatenate([self.ids, ids])
        slot = self._slot(h)
        free = ~self.taken[slot]
        self.slots[slot[free]] = place[free]
        self.taken[slot] = True


_seen: dict[tuple[str, bool], _Seen] = {}


def encode(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each text of a string array, in order; null and blank texts have none."""
    data, offsets = buffers(column)
    lo = 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1)
        part = data[offsets[lo] : offsets[hi]]
        raw = part.tobytes()
        fold = b"<|" not in raw  # names of special tokens have a case
        h, s, e, at = word_spans(part, offsets[lo : hi + 1] - offsets[lo], fold, (_letter, _other) if fold else None)
        seen = _seen.setdefault((path, fold), _Seen())
        place, new, first = seen.find(h)
        if len(new) + len(seen.hash) > KEPT:
            seen.__init__()
            place, new, first = seen.find(h)
        if len(new):
            seen.add(new, *_encode_words(path, [raw[a:b].decode() for a, b in zip(s[first].tolist(), e[first].tolist(), strict=True)]))
            place, _, _ = seen.find(h)
        size = seen.size[place]
        end = np.r_[0, np.cumsum(size, dtype=np.int64)]
        flat = seen.ids[np.repeat(seen.at[place] - end[:-1], size) + np.arange(end[-1])]
        stops = end[at]
        for d in range(hi - lo):
            yield flat[stops[d] : stops[d + 1]]
        lo = hi
