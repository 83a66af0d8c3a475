"""Token ids of many texts with the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import single_threaded

#: Parts of words that are kept; when twice as many are, the older half goes, so that a worker's memory stays bounded.
KEPT_PARTS = 500_000
#: Parts that are encoded as one text.
TOGETHER = 5_000

_MADE: dict[tuple[str, str], "Encoder"] = {}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes.

    Both vocabularies split text into pieces before merging and never merge across a single blank between two
    other characters, so texts are cut there, distinct cuts are looked up together and the results are joined, all on
    Arrow arrays. Letters and the marks after them are pieces of their own, so a cut is looked up as these two parts.
    cuts: "blank" cuts at single blanks and keeps the blank with what follows (byte-level vocabularies);
    "space" cuts at all white space, for vocabularies that drop it.
    """

    def __init__(self, path: str, cuts: str):
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.blank = cuts == "blank"
        self.lower = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("AÉ") == "aé"
        self.parts = Parts(path, self.tokenizer, self.blank)
        self.words = pa.array([""], pa.large_string())
        self.ids = pa.array([b""], pa.large_binary())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if len(self.words) > 2 * KEPT_PARTS:
            self.words, self.ids = (pa.concat_arrays([x.slice(len(x) - KEPT_PARTS)]) for x in (self.words, self.ids))
        out = [b""] * len(texts)
        plain, other, whole = [], [], []
        for i, text in enumerate(texts):
            if (_DOUBTFUL if self.blank else _UNSURE)(text):
                whole.append(i)
            elif self.blank or not _RARE(text):
                plain.append(i)
            else:
                other.append(i)
        if plain:
            rows = [texts[i] for i in plain]
            if self.blank:
                cut = pc.split_pattern(pa.array([self._marked(t) for t in rows], pa.large_string()), "\x00")
            else:
                cut = pc.ascii_split_whitespace(pa.array([t.lower() for t in rows] if self.lower else rows, pa.large_string()))
            for i, ids in zip(plain, self._joined(cut)):
                out[i] = ids
        if other:
            for i, ids in zip(other, self._joined(pa.array([texts[i].split() for i in other], pa.large_list(pa.large_string())))):
                out[i] = ids
        for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out

    @staticmethod
    def _marked(text: str) -> str:
        """Cuts before single blanks, and around line breaks that stand by themselves."""
        text = text.replace(" ", "\x00 ")
        return text if _BREAKS(text) else text.replace("\n", "\x00\n\x00")

    def _joined(self, cut) -> list[bytes]:
        """The ids of texts that are lists of cuts."""
        coded = cut.flatten().dictionary_encode()
        if not len(coded.dictionary):
            return [b""] * len(cut)
        ids = self._known(coded.dictionary).take(coded.indices)
        offsets, data = np.frombuffer(ids.buffers()[1], np.int64), memoryview(ids.buffers()[2] or b"")
        bounds = offsets[cut.offsets.to_numpy(zero_copy_only=False)].tolist()
        return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:])]

    def _known(self, cuts):
        """The ids of distinct cuts; parts that are not known yet are encoded and kept."""
        split = pc.extract_regex(cuts, _PARTS)
        odd = split.is_null()
        letters, marks = pc.struct_field(split, [0]), pc.struct_field(split, [1])
        if self.lower:
            letters = pc.utf8_lower(letters)
        both = pa.concat_arrays([pc.if_else(odd, cuts, letters), pc.if_else(odd, pa.scalar("", pa.large_string()), marks)])
        at = pc.index_in(both, value_set=self.words)
        if at.null_count:
            unknown = both.filter(at.is_null())
            new = unknown.unique()
            place = np.array(at.fill_null(0))
            place[np.array(at.is_null())] = len(self.words) + np.array(pc.index_in(unknown, value_set=new))
            at = pa.array(place)
            self._learn(new)
        ids = self.ids.take(at)
        return pc.binary_join_element_wise(ids[: len(cuts)], ids[len(cuts) :], pa.scalar(b"", pa.large_binary()))

    def _learn(self, new) -> None:
        one = pc.match_substring_regex(new, _ONE_PIECE)
        odd = new.filter(pc.invert(one)).to_pylist()
        new = new.filter(one)
        # In the order that they were numbered in: pieces and odd cuts are put back where they stood.
        found = pa.concat_arrays([self.parts.encode(new.to_pylist()), self.parts.each(odd)])
        is_one = np.array(one)
        place = np.where(is_one, np.cumsum(is_one) - 1, len(new) + np.cumsum(~is_one) - 1)
        self.words = pa.concat_arrays([self.words, pa.concat_arrays([new, pa.array(odd, pa.large_string())]).take(pa.array(place))])
        self.ids = pa.concat_arrays([self.ids, found.take(pa.array(place))])


class Parts:
    """Encodes runs of letters (in lower case where the vocabulary has only that) and of marks, each of them one piece.

    Many are encoded as one text, without the normaliser and the search for pieces, which cost more than merging. Where
    one piece ends is told by the vocabulary's mark of a word's end, or by a line break between pieces. A vocabulary
    for which that does not give the library's own ids is used as it is.
    """

    def __init__(self, path: str, whole, blank: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = whole
        self.fast = Tokenizer.from_file(path)
        self.fast.normalizer = None
        suffix = getattr(self.fast.model, "end_of_word_suffix", None)
        self.glue = "\n" if blank else " "
        cutter = pre_tokenizers.Split("\n", "isolated") if blank else pre_tokenizers.WhitespaceSplit()
        self.fast.pre_tokenizer = pre_tokenizers.Sequence([cutter, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.fast.get_vocab_size(), bool)
        if blank:
            self.ends[self.whole.encode("\n", add_special_tokens=False).ids[:1]] = True
        elif suffix:
            self.ends[[i for token, i in self.fast.get_vocab().items() if token.endswith(suffix)]] = True
        probe = [lead + w for w in ("the", "été", "straßen", "zzqxjv", "über", "a", "niño") for lead in ([" ", ""] if blank else [""])] + ["...", "#!?", "&"]
        found = self._together(probe)
        if found is None or not found.equals(self.each(probe)):
            self.fast = None

    def each(self, parts: list[str]):
        """The ids of any texts, by the library as it is."""
        return pa.array([array("I", e.ids).tobytes() for e in self.whole.encode_batch_fast(parts, add_special_tokens=False)], pa.large_binary())

    def _together(self, parts: list[str]):
        ids = np.array(self.fast.encode_batch_fast([self.glue.join(parts)], add_special_tokens=False)[0].ids, "<u4")
        end = self.ends[ids]
        if self.glue == "\n":
            last = np.append(np.flatnonzero(end), len(ids))
            last -= np.arange(len(last))
            ids = ids[~end]
        else:
            last = np.flatnonzero(end) + 1
        if len(last) != len(parts):
            return None
        return pa.Array.from_buffers(pa.large_binary(), len(last), [None, pa.py_buffer(4 * np.append(0, last)), pa.py_buffer(ids)])

    def encode(self, parts: list[str]):
        out = [self.each([])]
        for lo in range(0, len(parts), TOGETHER):
            some = parts[lo : lo + TOGETHER]
            found = self._together(some) if self.fast else None
            out.append(self.each(some) if found is None else found)
        return pa.concat_arrays(out)


#: A line break beside other white space.
_BREAKS = re.compile(r"\n(?:(?<=\s\n)|(?=\s))").search
#: A blank before white space, the mark used for cutting, or characters that some call white space and some don't:
#: texts with them are encoded whole.
_DOUBTFUL = re.compile(r" \s|\x00|[\x1c-\x1f\x85᠎]").search
_UNSURE = re.compile(r"[\x1c-\x1f\x85᠎]").search
#: Characters other than ASCII and Latin ones: of texts without them the library's lower case is Python's, composing
#: characters changes nothing, and white space is ASCII's.
_RARE = re.compile(r"[^\t-\r\x20-\x7e¡-įı-ɏ]").search
#: Letters and marks. Not U+0130: its lower case is an i and a mark, which is of the piece of the marks that follow.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+", "[.,;:!?*%&$#]"
_PARTS = f"^(?P<letters> ?{_LETTERS})(?P<marks>{_MARKS}*)$"
_ONE_PIECE = f"^(?: ?{_LETTERS}|{_MARKS}+)$"


def encoder(path: str, cuts: str) -> Encoder:
    """The worker's encoder for a vocabulary file; made once."""
    key = (path, cuts)
    if key not in _MADE:
        _MADE[key] = Encoder(path, cuts)
    return _MADE[key]
