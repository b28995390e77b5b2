"""Token ids of texts, with each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from llm.common import small_batches

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: What separates words for the split below: a superset of what any regex engine takes as white space.
WHITE = r"\s\x1c-\x1f\x85\u180e\u200b\ufeff"
# A space or line end that white space or nothing follows; a space that starts a word.
LOOSE = re.compile(rf"[ \n](?:[{WHITE}]|\Z)")
SPACED = re.compile(rf"[{WHITE}]")
START = re.compile(rf" (?=[^{WHITE}])")
LONGEST = 48
# Letters up to U+024F, where all versions of the Unicode tables agree on what a letter is; a line end may stand before
# them and a short run of ASCII marks behind. No apostrophe: the usual pattern knows it as the start of a contraction.
LATIN = "".join(chr(c) for c in range(0x250) if chr(c).isalpha())
LETTERED = re.compile(rf"(\n?[{LATIN}]+)([!-&(-/:-@\[-`{{-~]{{0,8}})")

#: Characters of text that are encoded at once, and new words of letters that the model gets as one run.
SPAN, JOINED = 3_000_000, 64

#: The fixed value that ends every document.
END = b"\0\0\0\0"


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all elements of runs that begin at ``starts``, run after run."""
    ends = np.cumsum(sizes, dtype=np.int64)
    out = np.repeat(starts - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


class Runs:
    """The ids of strings in one array, and a slot for each string that says where its ids stand."""

    def __init__(self):
        self.slots: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = 0

    def _room(self, name: str, used: int, wanted: int) -> None:
        held = getattr(self, name)
        if wanted > len(held):
            setattr(self, name, larger := np.zeros(max(wanted, 2 * len(held), 1024), held.dtype))
            larger[:used] = held[:used]

    def add(self, names: list[str], ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """New strings, with places in ``ids``."""
        n = len(self.slots)
        self._room("ids", self.used, self.used + len(ids))
        self._room("starts", n, n + len(names))
        self._room("sizes", n, n + len(names))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[n : n + len(names)] = starts + self.used
        self.sizes[n : n + len(names)] = sizes
        self.slots.update(zip(names, range(n, n + len(names))))
        self.used += len(ids)

    def of(self, names: list[str]) -> np.ndarray:
        """The slot of each string, -1 for one that is not held."""
        return np.fromiter(map(self.slots.get, names, repeat(-1)), np.int64, len(names))

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these slots one after the other, and their numbers."""
        sizes = self.sizes[slots]
        return self.ids[_places(self.starts[slots], sizes)], sizes

    def copy_from(self, other: Runs, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Adds those that the other one holds. Returns their places in ``names``, and those of the rest."""
        found = other.of(names) if other.slots else np.full(len(names), -1)
        here = np.nonzero(found >= 0)[0]
        if len(here):
            ids, sizes = other.take(found[here])
            self.add([names[k] for k in here.tolist()], ids, np.cumsum(sizes) - sizes, sizes)
        return here, np.nonzero(found < 0)[0]


class WordEncoder:
    """Ids of whole texts as little-endian uint32 bytes, equal to encode(text, add_special_tokens=False).

    A byte-level BPE with the usual pattern never joins text across a space that starts a word (" word": a space,
    then no white space): whatever white space stands before that space is a token run of its own, and the space
    goes with the word. A line end between words is a run of its own as well. So texts are cut before those spaces and
    line ends; the distinct pieces of a span of texts that were not met before are encoded together, as one text of
    lines, and cut apart at the line ends. Marks behind letters are a run of their own too, so letters are encoded
    without them. As letters are a single run, they need no pattern: they go as byte characters to the same model, many
    words a call. Between them stands a control character that no longer entry of the vocabulary holds, so that no merge
    crosses it; if there is none, a line end and a plain split at it. The caches hold ``bound`` pieces and 16 ids
    for each of them; when the newer is full it becomes the older. Texts that hold the string of an added token, and tokenizers of any other kind, are encoded as a
    whole. A lone surrogate is read as '?'.
    """

    def __init__(self, path: str, bound: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = str(self.tokenizer.pre_tokenizer)
        plain = "add_prefix_space=False" in kind and "use_regex=True" in kind
        self.cuts = kind.startswith("ByteLevel") and plain and not self.tokenizer.normalizer and not self.tokenizer.post_processor
        self.words, self.older, self.marks, self.bound = Runs(), Runs(), Runs(), bound
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.runs = None
        if self.cuts and self.line is not None:
            from tokenizers import pre_tokenizers

            # Characters that stand for bytes: those below 256 for themselves, the others in order for what is left.
            signs = sorted(pre_tokenizers.ByteLevel.alphabet())
            left = [b for b in range(256) if chr(b) not in signs]
            self.signs = np.arange(256, dtype="<u2")
            self.signs[left] = [ord(s) for s in signs if ord(s) > 255]
            self.runs = Tokenizer.from_file(path)
            model, vocab = self.runs.model, self.runs.get_vocab(with_added_tokens=False)
            odd = ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
            joined = set().union(*(t for t in vocab if len(t) > 1))
            lone = [b for b in range(32) if (sign := chr(self.signs[b])) in vocab and sign not in joined]
            if lone and not any(getattr(model, x, None) for x in odd):
                self.part, self.runs.pre_tokenizer = lone[0], None
            else:
                self.part, self.runs.pre_tokenizer = 10, pre_tokenizers.Split(chr(self.signs[10]), "isolated")
            self.part_id = vocab[chr(self.signs[self.part])]
            if hasattr(model, "_resize_cache"):
                model._resize_cache(0)  # every word comes once

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _add_alone(self, held: Runs, name: str, text: str) -> None:
        ids = np.frombuffer(self._whole(text), "<u4")
        held.add([name], ids, np.zeros(1, np.int64), np.array([len(ids)]))

    def _add_parts(self, tokenizer, part: int, names: list[str], texts: list[str], lined: bool) -> None:
        """Adds pieces from texts in which the single id ``part`` stands between them. A ``lined`` piece begins with the
        id of a line end instead."""
        ids = [part]
        for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids += found.ids
            ids.append(part)
        ids = np.array(ids, "<u4")
        ends = np.nonzero(ids == part)[0]
        ids[ends] = self.line
        self.words.add(names, ids, ends[:-1] + (not lined), np.diff(ends) - (not lined))

    def _learn(self, wanted: list[str]) -> np.ndarray:
        """Adds pieces that ``words`` does not hold and returns their slots: "word" stands for " word", and "\nword" for
        itself."""
        slots, n = np.empty(len(wanted), np.int64), len(self.words.slots)
        known, rest = self.words.copy_from(self.older, wanted)
        slots[known] = n + np.arange(len(known))
        if len(rest):
            new = [wanted[k] for k in rest.tolist()]
            self._learn_new(new)
            slots[rest] = self.words.of(new)
        return slots

    def _learn_new(self, wanted: list[str]) -> None:
        held = self.words.slots
        letters, others, tailed, bases, tails = {}, [], [], [], []
        for word, found in zip(wanted, map(LETTERED.fullmatch, wanted) if self.runs is not None else repeat(None)):
            if found:
                base, tail = found.groups()
                if tail:
                    tailed.append(word)
                    bases.append(base)
                    tails.append(tail)
                letters[base] = None
            else:
                others.append(word)
        letters = [w for w in letters if w not in held]
        if self.older.slots:
            letters = [letters[k] for k in self.words.copy_from(self.older, letters)[1].tolist()]
        for own, learn in ((letters, self._learn_letters), (others, self._learn_others)):
            lined = [w for w in own if w[:1] == "\n"]
            learn([w for w in own if w[:1] != "\n"] if lined else own, False)
            learn(lined, True)
        if tailed:
            self._learn_tailed(tailed, bases, tails)

    def _learn_letters(self, own: list[str], lined: bool) -> None:
        if own:
            size = len(own) if self.part == 10 else JOINED
            groups, mark = [own[k : k + size] for k in range(0, len(own), size)], chr(self.part)
            texts = ["".join(g)[1:].replace("\n", mark) if lined else " " + f"{mark} ".join(g) for g in groups]
            signs = self.signs[np.frombuffer("\n".join(texts).encode(), "u1")].tobytes().decode("utf-16-le")
            if any(a in signs for a in self.added):
                self._learn_others(own, lined)
            else:
                self._add_parts(self.runs, self.part_id, own, signs.split(chr(self.signs[10])) if len(texts) > 1 else [signs], lined)

    def _learn_others(self, own: list[str], lined: bool) -> None:
        bare = [w[1:] for w in own] if lined else own
        if self.line is None or SPACED.search("".join(bare)) or not all(bare):
            spaced = {w for w, b in zip(own, bare) if self.line is None or SPACED.search(b) or not b}
            for w in spaced:
                self._add_alone(self.words, w, w if lined else " " + w)
            own = [w for w in own if w not in spaced]
            bare = [w[1:] for w in own] if lined else own
        if own:
            self._add_parts(self.tokenizer, self.line, own, ["\n".join(bare) if lined else "\n".join(" " + w for w in bare)], lined)

    def _learn_tailed(self, own: list[str], bases: list[str], tails: list[str]) -> None:
        if len(self.marks.slots) > 10_000:
            self.marks = Runs()
        for tail in set(tails):
            if tail not in self.marks.slots:
                self._add_alone(self.marks, tail, tail)
        (front, before), (back, behind) = self.words.take(self.words.of(bases)), self.marks.take(self.marks.of(tails))
        sizes = before + behind
        starts = np.cumsum(sizes) - sizes
        ids = np.empty(len(front) + len(back), "<u4")
        ids[_places(starts, before)] = front
        ids[_places(starts + before, behind)] = back
        self.words.add(own, ids, starts, sizes)

    def _cut(self, texts: list[str]) -> pa.ListArray:
        """The texts cut before spaces that start a word, and before line ends where all stand between words."""
        loose = [bool(LOOSE.search(t)) for t in texts]
        cut = pa.array([START.split(t) for t, x in zip(texts, loose) if x], pa.list_(pa.string()))
        if len(cut) == len(texts):
            return cut
        plain = pa.array([t for t, x in zip(texts, loose) if not x], pa.string())
        plain = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        if not len(cut):
            return plain
        behind = np.cumsum(loose)
        order = np.where(loose, behind - 1 + len(plain), np.arange(len(texts)) - behind)
        return pa.concat_arrays([plain, cut]).take(pa.array(order))

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens, each distinct piece of which is looked up once."""
        cut = self._cut(texts)
        pieces, counts = cut.flatten(), cut.value_lengths().to_numpy()
        ends = np.cumsum(counts, dtype=np.int64)
        first = ends - counts
        rest = np.ones(len(pieces), bool)
        rest[first] = False
        coded = pieces.filter(pa.array(rest)).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = self.words.of(names)
        if len(new := np.nonzero(slots < 0)[0]):
            slots[new] = self._learn([names[k] for k in new.tolist()])
        ids, sizes = self.words.take(slots[coded.indices.to_numpy()])
        edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.concatenate([[0], ends - np.arange(1, len(ends) + 1)])]
        data, edges = memoryview(ids.tobytes()), (4 * edges).tolist()
        heads = (self._whole(h) if h else b"" for h in pieces.take(pa.array(first)).to_pylist())
        if len(self.words.slots) > self.bound or self.words.used > 16 * self.bound:
            self.older, self.words = self.words, Runs()
            self.older.slots = {w: k for w, k in self.older.slots.items() if len(w) <= LONGEST}
        return [head + data[a:b] for head, a, b in zip(heads, edges, edges[1:])]

    def _encode_span(self, texts: list[str]) -> list[bytes]:
        whole = [not self.cuts or any(a in t for a in self.added) for t in texts]
        rest = [t for t, w in zip(texts, whole) if not w]
        found = iter(self._encode(rest) if rest else ())
        return [self._whole(t) if w else next(found) for t, w in zip(texts, whole)]

    def encode_rows(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        """(key, ids) of (key, text) in the given order, with a span of texts held at a time."""
        keys, texts, size = [], [], 0
        for key, text in rows:
            keys.append(key)
            texts.append(text.encode("utf-8", "replace").decode() if text else "")
            size += len(texts[-1])
            if size >= SPAN:
                yield from zip(keys, self._encode_span(texts))
                keys, texts, size = [], [], 0
        yield from zip(keys, self._encode_span(texts))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        return [ids for _, ids in self.encode_rows((None, t) for t in texts)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(first column, second column) of every row."""
    for part in small_batches(batch, 256):
        yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
