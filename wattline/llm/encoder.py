"""Token ids of texts with a public tokenizer, each distinct word encoded once a task."""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from wattline.llm.common import KEPT, tidy

#: Distinct words remembered by a worker.
WORDS = 800_000
#: A line of Latin letters, and marks of ASCII behind them; or any other line.
MARKED = re.compile("^(?:([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)|(.+))$", re.MULTILINE)


def default_path() -> str:
    """The default vocabulary. Its file has to be on every worker."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts, each followed by an end id, for tokenizers that split at ASCII white space and drop it.

    Then a text's ids are those of its words one after another, and each distinct word needs to be encoded once. With
    `lower` (for tokenizers that lower-case and part letters from marks) words that differ in A-Z only are one, and a word
    of Latin letters with marks behind is encoded as both. What may be a special token, anything with `<|`, is left in
    its case.
    """

    def __init__(self, path: str, end: int = 1, lower: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.end, self.lower = end, lower
        suffix = self.tokenizer.model.end_of_word_suffix or "\n"
        self.ends = np.zeros(1 << 16 if self.tokenizer.get_vocab_size() < 1 << 16 else self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.kind = np.uint16 if max(self.tokenizer.get_vocab_size() - 1, end) < 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes | None, int] = {None: 0, b"": 1}  # None is the end; no word lies before white space that begins a text
        self.flat = np.full(1 << 16, self.end, self.kind)
        self.start, self.size, self.used = np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.int32), 1
        self.size[1] = 0

    def put(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember the ids of new words, one after another in `ids`."""
        at, end = len(self.place), self.used + len(ids)
        while end > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        while at + len(words) > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * len(self.start)), np.resize(self.size, 2 * len(self.size))
        self.flat[self.used : end] = ids
        self.start[at : at + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.size[at : at + len(words)] = sizes
        self.used = end
        self.place.update(zip(words, range(at, at + len(words))))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places one after another, and the size of each."""
        size = self.size[at].astype(np.int64)
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], size

    def learn(self, new: list[bytes]) -> None:
        """Remember words that are not known."""
        whole, single, split = [] if self.lower else new, set(), {}
        for w, (letters, marks, other) in zip(new, MARKED.findall(b"\n".join(new).decode())) if self.lower else ():
            if other or "<|" in marks:
                whole.append(w)
            elif w.isalpha():
                single.add(w)
            else:
                end = len(w) - len(marks)
                first = w[:end].lower() if len(letters) == end else letters.lower().encode()
                if first == w:
                    single.add(w)
                else:
                    split[w] = (first, w[end:]) if marks else (first,)
        for parts in split.values():
            single.update(parts)
        self.encode_single([w for w in single if w not in self.place])
        self.encode_whole([w for w in whole if w not in self.place])
        ids, sizes = self.gather(np.fromiter((self.place[x] for y in split.values() for x in y), np.int64))
        ends = np.concatenate([[0], np.cumsum([len(x) for x in split.values()], dtype=np.int64)])
        self.put(list(split), ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[ends]))

    def encode_single(self, words: list[bytes], at_once: int = 500) -> None:
        """Words that are one run of letters or of marks: encoded together, for each ends with a token of an end."""
        groups = [words[i : i + at_once] for i in range(0, len(words), at_once)]
        for own, e in zip(groups, self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(own):
                self.put(own, ids, np.diff(ends, prepend=0))
            else:
                self.encode_whole(own)

    def encode_whole(self, words: list[bytes]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)):
            self.put([w], np.array(e.ids, self.kind), np.array([len(e.ids)]))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Where each word is remembered; -1 for those that are not."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has. Each distinct word is looked up once."""
        low = [t.lower() if self.lower and b"<|" not in t else t for t in texts]
        split = pc.ascii_split_whitespace(pa.array(low, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        one = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), pa.scalar("\n", pa.large_string()))  # quicker to split than to unbox
        words = one.cast(pa.large_binary())[0].as_py().split(b"\n") if len(coded.dictionary) else []
        at = self.places(words)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            if len(self.place) + len(unknown) > WORDS:
                self.forget()
                self.learn([w for w in words if w])
                at = self.places(words)
            else:
                own = [words[i] for i in unknown.tolist()]
                self.learn(own)
                at[unknown] = self.places(own)
        ends = split.offsets.to_numpy()[1:].astype(np.int64)
        ids, size = self.gather(np.insert(at[coded.indices.to_numpy()], ends, 0))
        return ids, np.diff(np.cumsum(size)[ends + np.arange(len(texts))], prepend=0)


def encoder(path: str, end: int = 1, lower: bool = True) -> WordEncoder:
    """The worker's encoder for a vocabulary: the tasks of a stage share it."""
    tidy()
    key = ("encoder", path, end, lower)
    if key not in KEPT:
        KEPT[key] = WordEncoder(path, end, lower)
    return KEPT[key]
