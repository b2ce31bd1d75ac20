"""Token ids of whole texts, encoded once for each different piece of text.

Both tokenizers used here cut a text at white space before they merge: what stands on one side of
such a cut never changes the ids of the other side. So a task encodes each new piece once, keeps
its ids as bytes, and joins the bytes of a text's pieces. A text that holds the string of a special
token is encoded as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: New pieces a worker remembers; then they become the older ones, and those before are forgotten
#: unless they were met again (about 250 MB for both).
REMEMBERED = 600_000
#: Pieces that are encoded as one text.
TOGETHER = 1000

_BEFORE_WORD = re.compile(r" (?=\S)")
_SPACE_RUN = re.compile(r" \s| \Z")
#: White space other than the space and the line feed.
_OTHER_WHITE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: That of ASCII, and the mark of a line's first word.
_OTHER_ASCII = [bytes([c]) for c in b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\0"]
_DOUBLE_WHITE = (b"  ", b"\n\n", b" \n", b"\n ")


class Encoder:
    """``keeps_space``: the tokenizer puts a space into the token of the word behind it; else it
    drops white space."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = self._tokenizer.get_added_tokens_decoder()
        self._special = [t.content.encode() for t in special.values()]
        self._between, self._between_id = next((t.content, i) for i, t in special.items())
        self._keeps_space = keeps_space
        # A word's last token has the end mark, or its first one the space before it.
        vocabulary = self._tokenizer.get_vocab()
        self._edge = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self._edge[i] = token.startswith("\u0120") if keeps_space else token.endswith("</w>")
        self._plain = self._plain_tokenizer()
        self._new: dict = {}
        self._old: dict = {}
        # A full stop or comma behind a letter or digit is a token of its own, but for letters that the
        # tokenizer turns into a letter and a mark: it takes the mark and what follows together.
        self._marks = dict(zip(".,", self._encoded([".", ","])))
        self._stands: dict[str, bool] = {}
        self._stands_before_mark = np.array([chr(c).isalnum() and c < 128 and self._ends_word(chr(c)) for c in range(256)])

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, none of which holds a special token: a special token stands between them."""
        texts = [self._between.join(pieces[i:i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        found: list[bytes] = []
        for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            cuts, data = np.flatnonzero(ids == self._between_id).tolist(), ids.tobytes()
            found += [data[4 * a + 4:4 * b] for a, b in zip([-1, *cuts], [*cuts, len(ids)])]
        return found

    def _encoded_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only."""
        if self._plain is None:
            return self._encoded_running(self._tokenizer, words)
        simple = [w.isascii() for w in words]
        plain = iter(self._encoded_running(self._plain, [w for w, s in zip(words, simple) if s]))
        others = iter(self._encoded_running(self._tokenizer, [w for w, s in zip(words, simple) if not s]))
        return [next(plain if s else others) for s in simple]

    def _encoded_running(self, tokenizer, words: list[str]) -> list[bytes]:
        """Ids of words of letters only: as running text, cut again where a word's tokens end."""
        space = " " if self._keeps_space else ""
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        texts = [space + " ".join(g) for g in groups]
        if not texts:
            return []
        if tokenizer is self._plain:
            texts = [self._plain_text(t) for t in texts]
        found: list[bytes] = []
        for group, e in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            edges = np.flatnonzero(self._edge[ids])
            if len(edges) != len(group):  # a letter whose lower case isn't one: a word is cut further
                found += self._encoded([space + w for w in group])
                continue
            cuts = [*edges.tolist(), len(ids)] if self._keeps_space else [0, *(edges + 1).tolist()]
            data = ids.tobytes()
            found += [data[4 * a:4 * b] for a, b in zip(cuts, cuts[1:])]
        return found

    def _plain_text(self, text: str) -> str:
        """What normalizer and pre-tokenizer make of ASCII words, with a space between words."""
        text = text.lower() if self._lowers else text
        return text.replace(" ", " \u0120") if self._keeps_space else text

    def _plain_tokenizer(self):
        """The same merges without regular expressions, for words of ASCII letters; None if they differ there."""
        from tokenizers import Tokenizer, pre_tokenizers

        probe = f" {ascii_letters} a Bc"
        normalizer, cutter = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer
        normal = normalizer.normalize_str(probe) if normalizer else probe
        self._lowers = normal != probe
        words = [w for w, _ in cutter.pre_tokenize_str(normal)] if cutter else []
        if normal not in (probe, probe.lower()) or words != self._plain_text(probe).split():
            return None
        plain = Tokenizer(self._tokenizer.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return plain

    def _ends_word(self, letter: str) -> bool:
        """Whether a full stop or comma behind this letter or digit leaves its tokens as they are."""
        known = self._stands.get(letter)
        if known is None:
            word = f"a{letter}"
            plain, *marked = self._encoded([word, *(word + m for m in self._marks)])
            known = all(m == plain + own for m, own in zip(marked, self._marks.values()))
            self._stands[letter] = known
        return known

    def _pieces(self, text: bytes) -> list:
        """Pieces as they stand, in a tuple, and those behind a space without it."""
        decoded = text.decode()
        cut = _BEFORE_WORD.split if _SPACE_RUN.search(decoded) else _plain_cut
        first, *rest = cut(decoded)
        return [(first,), *rest]

    def _text(self, piece) -> str:
        return piece[0] if isinstance(piece, tuple) else " " + piece

    def _learn_words(self, pieces: list[bytes]) -> None:
        """As :meth:`_learn`, for pieces without white space around them."""
        new, marks = self._new, self._marks
        gone = list(map(self._old.get, pieces))
        new.update((p, ids) for p, ids in zip(pieces, gone) if ids is not None)
        wanted = [p for p, ids in zip(pieces, gone) if ids is None]
        letters: dict[bytes, str] = {}
        others: dict[bytes, str] = {}
        marked = []
        for p, text in zip(wanted, [p.decode() for p in wanted]):
            if text.isalpha():
                letters[p] = text
                continue
            mark = text[-1:]
            if mark in marks and len(text) > 1 and text[-2].isalnum() and self._ends_word(text[-2]):
                stem, text = p[:-1], text[:-1]
                marked.append((p, stem, mark))
                if stem in new:
                    continue
                (letters if text.isalpha() else others)[stem] = text
            else:
                others[p] = text
        new.update(zip(letters, self._encoded_words(list(letters.values()))))
        new.update(zip(others, self._encoded(list(others.values()))))
        for p, stem, mark in marked:
            new[p] = new[stem] + marks[mark]

    def _learn(self, pieces: list) -> list[bytes]:
        """Remember different pieces that aren't known; their ids."""
        new, marks, ends_word = self._new, self._marks, self._ends_word
        found = list(map(self._old.get, pieces))
        wanted = list(range(len(pieces)))
        if self._old:
            wanted = [i for i in wanted if found[i] is None]
        words: list[str] = []
        at: list[int] = []
        others: dict = {}
        marked = []
        for i in wanted:
            p = pieces[i]
            if type(p) is str and p.isalpha():
                words.append(p)
                at.append(i)
                continue
            text = p[0] if type(p) is tuple else p
            if text[-1:] in marks and len(text) > 1 and text[-2].isalnum() and ends_word(text[-2]):
                marked.append((i, (text[:-1],) if type(p) is tuple else p[:-1], text[-1]))
            else:
                others[p] = i
        for i, ids in zip(at, self._encoded_words(words)):
            found[i] = ids
        for i, ids in zip(others.values(), self._encoded(list(map(self._text, others)))):
            found[i] = ids
        new.update(zip(pieces, found))
        if marked:
            stems = [s for s in dict.fromkeys(s for _, s, _ in marked) if s not in new]
            letters = [s for s in stems if type(s) is str and s.isalpha()]
            rest = [s for s in stems if type(s) is tuple or not s.isalpha()]
            new.update(zip(letters, self._encoded_words(letters)))
            new.update(zip(rest, self._encoded(list(map(self._text, rest)))))
            for i, stem, mark in marked:
                found[i] = new[pieces[i]] = new[stem] + marks[mark]
        return found

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self._new) > REMEMBERED:
            self._old, self._new = self._new, {}
        whole = [any(s in t for s in self._special) for t in texts]
        if not self._keeps_space:
            joined = self._word_ids([b"" if w else t for t, w in zip(texts, whole)])
            return [self._encode_whole(t) if w else j for t, w, j in zip(texts, whole, joined)]
        marked = [None if w else _marked(t) for t, w in zip(texts, whole)]
        joined = iter(self._marked_ids([m for m in marked if m is not None]))
        return [self._encode_whole(t) if w else self._piece_ids(t) if m is None else next(joined)
                for t, w, m in zip(texts, whole, marked)]

    def _piece_ids(self, text: bytes) -> bytes:
        """The ids of one text, white space of any kind."""
        pieces = self._pieces(text)
        self._learn([p for p in dict.fromkeys(pieces) if p not in self._new])
        return b"".join(map(self._new.__getitem__, pieces))

    def _marks_apart(self, texts: pa.StringArray) -> pa.StringArray:
        """Texts of :func:`_marked` with a full stop or comma that ends a word as a piece of its own."""
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[:len(texts) + 1]
        old = np.frombuffer(data, np.uint8)[:ends[-1]]
        last = np.zeros(len(old), bool)
        last[ends[1:] - 1] = True
        last[:-1] |= old[1:] == ord(" ")
        at = np.flatnonzero(((old == ord(".")) | (old == ord(","))) & last)
        at = at[self._stands_before_mark[old[at - 1]]]
        # A space and the mark of a missing space go before each.
        place = at + 2 * np.arange(len(at))
        found = np.zeros(len(old) + 2 * len(at), np.uint8)
        kept = np.ones(len(found), bool)
        kept[place] = kept[place + 1] = False
        found[kept], found[place] = old, ord(" ")
        ends = (ends + 2 * np.searchsorted(at, ends)).astype(np.int32)
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(found))

    def _marked_ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts of :func:`_marked`: each different piece of them is looked up once."""
        if not texts:
            return []
        cut = pc.split_pattern(self._marks_apart(pa.array(texts, pa.binary()).cast(pa.string())), " ")
        words = cut.flatten().dictionary_encode()
        # A line feed between words is a token, and so is no part of a word beside it.
        pieces = [(p[1:],) if p[0] == "\0" else _LINE_END if p == "\n" else p
                  for p in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
        known = list(map(self._new.get, pieces))
        gaps = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(gaps, self._learn([pieces[i] for i in gaps])):
            known[i] = ids
        return _taken(known, words.indices.to_numpy(), cut.offsets.to_numpy())

    def _word_ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts cut at any white space: each different word of them is looked up once."""
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        words = cut.flatten().dictionary_encode()
        # As an array of objects first: ``to_pylist`` makes an Arrow scalar of each.
        pieces = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = list(map(self._new.get, pieces))
        gaps = [i for i, ids in enumerate(known) if ids is None]
        self._learn_words([pieces[i] for i in gaps])
        for i in gaps:
            known[i] = self._new[pieces[i]]
        return _taken(known, words.indices.to_numpy(), cut.offsets.to_numpy())

    def _encode_whole(self, text: bytes) -> bytes:
        found = self._tokenizer.encode(text.decode(), add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()


_LINE_END = ("\n",)


def _marked(text: bytes) -> bytes | None:
    """Words with one space or line feed between them as pieces with a space between them: line feeds are
    pieces, and the first word of a line, with no space before it, starts with a mark. None for other texts."""
    if not text or text[0] in b" \n" or text[-1] in b" \n" or any(d in text for d in _DOUBLE_WHITE) \
            or any(c in text for c in _OTHER_ASCII):
        return None
    if not text.isascii() and _OTHER_WHITE.search(text.decode()):
        return None
    return b"\0" + text.replace(b"\n", b" \n \0")


def _taken(known: list[bytes], which: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Texts put together of the ids of known pieces: ``which`` of them, cut at ``offsets``."""
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
    starts = np.cumsum(sizes) - sizes
    n = sizes[which]
    ends = np.concatenate([[0], np.cumsum(n)])
    taken = np.arange(ends[-1]) + np.repeat(starts[which] - ends[:-1], n)
    data = np.frombuffer(b"".join(known), "<u4")[taken].tobytes()
    bounds = (4 * ends[offsets]).tolist()
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def _plain_cut(text: str) -> list[str]:
    return text.split(" ")


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker process's own, until a task of another kind calls :func:`forget`."""
    if (path, keeps_space) not in _encoders:
        _encoders[path, keeps_space] = Encoder(path, keeps_space)
    return _encoders[path, keeps_space]


def forget() -> None:
    """Free the memory of tokenizers and of the pieces they met (some 250 MB) in this worker process.

    Spark gives an idle worker to the tasks of the next stage, whatever it did before.
    """
    _encoders.clear()


def id_lists(parts: Iterable[bytes]) -> pa.ListArray:
    """Lists of ids as an Arrow column, without a copy for each id."""
    parts = list(parts)
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=ends[1:])
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def id_bytes(column: pa.ListArray) -> Iterator[bytes]:
    """The lists of an Arrow column of ids, each as bytes."""
    data = column.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]) * 4
    return (data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))
