"""Byte-pair encoding of whole texts by the ``tokenizers`` library, one call of it per new word.

A byte-level BPE with the usual pre-tokeniser pattern never joins a character with the space after it, and it
treats the last space of a run as part of the next word. A text without doubled spaces and without a space at its end can
therefore be cut before each space, and the pieces encoded on their own give the ids of the whole text. A line end between two characters that
aren't white space is a piece of its own, and so is a mark between a letter and a space or a line end. Batches are cut and put together again by columns; only
words that the cache doesn't hold are looked at one by one.

Other texts, and those with a special token's string in them, go to the library whole; so does everything if the tokenizer file has another model or pre-tokeniser.
"""

from __future__ import annotations

import json
import os

import numpy as np

MAX_CACHED = 200_000
WORDS_A_CALL = 128
MARKS = ".,;:!?"
#: What stands before a word: a space, the text's begin or a line end.
_BEGIN, _LINE = "\0", "\x01"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_ODD_LINE = r"^\n|\n$|\n[^!-~\pL]|[^!-~\pL]\n"
_ENCODERS: dict[str, "Encoder"] = {}


def public_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> str:
    """The letter by which a byte-level vocabulary writes each of the 256 bytes: printable Latin-1 as it is, the rest from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in kept else next(rest)) for b in range(256))


def _large(x):
    import pyarrow as pa

    return pa.scalar(x, pa.large_string())


class Encoder:
    """Text to ids. The cache holds words, not results, and is emptied when full."""

    def __init__(self, path: str | None = None, max_cached: int = MAX_CACHED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_path())
        self.tokenizer.encode_special_tokens = True
        self.specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_cached = max_cached
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        marks = self._library([*MARKS, "\n"])
        self.by_words = all(len(x) == 1 for x in marks) and self._usual(letters)
        if self.by_words:
            self.newline, self.marks = marks[-1][0], [x[0] for x in marks[:-1]]
            self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.spaced[[i for x, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if x[0] == letters[32]]] = True
        self._clear()

    def _usual(self, letters: str) -> bool:
        """Whether the file has a plain byte-level BPE without a normaliser, cut by the usual pattern.

        Among the entries that Latin words, spaces and line ends can make up, none may have a space behind anything, or a line end beside anything but line ends.
        """
        kind = json.loads(self.tokenizer.to_str())
        model, cut = kind["model"], kind["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        space, line = letters[32], letters[10]
        latin = {letters[b] for b in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA), 32, 10)}
        apart = plain and not any(latin.issuperset(x) for x in model["vocab"] if space in x[1:] or line in x and x.strip(line))
        return plain and apart and kind["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex") is True

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _keep(self, pieces: list[str], ids, sizes) -> None:
        self.slots.update(zip(pieces, range(len(self.ends) - 1, len(self.ends) - 1 + len(pieces))))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, np.asarray(ids, np.uint32)])

    def _model(self, pieces: list[str], between: str) -> None:
        """Latin words, with a space before each or none, straight from the library's model, many a call. ``between`` is the space, or else a line end, which
        no entry of the vocabulary has but as its first letter or by itself, so that the words don't touch each other."""
        ids: list[int] = []
        for k in range(0, len(pieces), WORDS_A_CALL):
            text = between + between.join(x.lstrip(" ") for x in pieces[k : k + WORDS_A_CALL])
            letters = text.encode().decode("latin-1").translate(self.letters)
            ids += [t.id for t in self.tokenizer.model.tokenize(letters)]
        ids = np.array(ids, np.uint32)
        if between == " ":
            begins = np.flatnonzero(self.spaced[ids])
            sizes = np.diff(begins, append=len(ids))
        else:
            begins = np.flatnonzero(ids == self.newline)
            sizes = np.diff(begins, append=len(ids)) - 1
            ids = ids[ids != self.newline]
        if len(sizes) != len(pieces):
            raise RuntimeError("the model's pieces do not match its words")
        self._keep(pieces, ids, sizes)

    def _fill(self, pieces: list[str], plain: list[bool]) -> None:
        """Every piece gets into the cache; ``plain`` ones are Latin letters, perhaps behind a space."""
        if len(self.slots) > self.max_cached:
            self._clear()
        slots = self.slots
        new = [(x, known) for x, known in zip(pieces, plain) if x not in slots]
        self._model([x for x, known in new if known and x[0] == " "], " ")
        self._model([x for x, known in new if known and x[0] != " "], "\n")
        odd = [x for x, known in new if not known]
        rows = self._library(odd) if odd else []
        self._keep(odd, [i for ids in rows for i in ids], [len(ids) for ids in rows])

    def _words(self, words) -> tuple:
        """(ids, start, size) of every word of an Array of distinct ones."""
        import pyarrow as pa
        import pyarrow.compute as pc

        begin, line = pc.starts_with(words, _BEGIN), pc.starts_with(words, _LINE)
        lead = pc.or_(begin, line)
        content = pc.if_else(lead, pc.utf8_slice_codeunits(words, 1), words)
        body = pc.utf8_slice_codeunits(content, 0, -1)
        mark = pc.index_in(pc.utf8_slice_codeunits(content, -1), value_set=pa.array(list(MARKS), pa.large_string()))
        marked = pc.and_(pc.is_valid(mark), pc.match_substring_regex(body, f"^[{_LATIN}]+$"))
        content = pc.if_else(marked, body, content)
        pieces = pc.binary_join_element_wise(pc.if_else(lead, _large(""), _large(" ")), content, _large("")).dictionary_encode()
        distinct = pieces.dictionary
        names = distinct.to_numpy(zero_copy_only=False).tolist()
        self._fill(names, pc.match_substring_regex(distinct, f"^ ?[{_LATIN}]+$").to_numpy(zero_copy_only=False).tolist())
        slot = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))[pieces.indices.to_numpy()]
        flat, ends = self.flat, self.ends
        line, marked = line.to_numpy(zero_copy_only=False), marked.to_numpy(zero_copy_only=False)
        start, inner = ends[slot], ends[slot + 1] - ends[slot]
        size = inner + line + marked
        at = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        out[_ragged(at + line, inner)] = flat[_ragged(start, inner)]
        out[at[line]] = self.newline
        out[(at + size - 1)[marked]] = np.array(self.marks, np.uint32)[mark.to_numpy(zero_copy_only=False)[marked].astype(np.int64)]
        return out, at, size

    def encode(self, texts) -> tuple:
        """(ids of all texts as one uint32 array, the offsets of each text in it) of an Arrow string array; null counts as empty."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), _large(""))
        if self.by_words:
            whole = pc.or_(pc.match_substring(texts, "  "), pc.ends_with(texts, " "))
            for x in (_BEGIN, _LINE, *self.specials):
                whole = pc.or_(whole, pc.match_substring(texts, x))
        else:
            whole = pa.array(np.ones(len(texts), bool))
        rest = pc.if_else(whole, _large(""), texts)
        rest = pc.if_else(pc.match_substring_regex(rest, _ODD_LINE), rest, pc.replace_substring(rest, "\n", " " + _LINE))
        split = pc.split_pattern(pc.binary_join_element_wise(_large(_BEGIN), rest, _large("")), " ")
        if self.by_words:
            coded = split.flatten().dictionary_encode()
            flat, start, size = self._words(coded.dictionary)
            at = coded.indices.to_numpy()
            n = size[at]
            ids = flat[_ragged(start[at], n)]
            offsets = np.concatenate([[0], np.cumsum(n)])[split.offsets.to_numpy() - split.offsets[0].as_py()] if len(texts) else np.zeros(1, np.int64)
        else:
            ids, offsets = np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        which = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(which):
            return ids, offsets
        each = [ids[a:b] for a, b in zip(offsets, offsets[1:])]
        for i, got in zip(which.tolist(), self._library(texts.take(pa.array(which)).to_pylist())):
            each[i] = np.array(got, np.uint32)
        return np.concatenate([*each, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)])


def _ragged(start, length):
    """start, start + 1, ... for each length, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this process."""
    path = path or public_path()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
