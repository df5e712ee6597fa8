"""Token ids and counts of whole texts, exactly as the tokenizer libraries give them.

A text is cut where the tokenizer's own first split always cuts, and each distinct chunk is encoded once per
Python worker.  Texts with characters on which the libraries' character classes may differ go to the library whole.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered per Python worker, and their greatest length: bounds its memory (two workers share an executor with a
#: JVM).  Every batch numbers them anew, so more of them cost as much time as they save.
REMEMBERED, LONGEST = 250_000, 64
#: Words of these characters lower-case letter by letter and are cut by the pattern below as by the tokenizer's own.
_LATIN = "^[!-;=-~À-ÖØ-öø-ÿ]{1,64}$"
_PIECE = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-zß-öø-ÿ0-9]+"
#: Beyond these the Unicode versions of two regex engines may differ; so long a run is slow in one of them.
_PLAIN = re.compile("[\x00-ɏ‐-‧€]*")
_LONG_RUN = re.compile(r"\S{1000}")


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable, else one from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(other)}


_BYTE_OF = _byte_characters()


def tokenizer_path(name: str) -> str:
    """An absolute path as it is; a bare name is a file of the installed public tokenizers."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of texts by a tokenizer that lower-cases, drops white space and marks the ends of words.

    New words go through a second encoder with the same merges, in which a zero byte stands for the end of a word;
    words beyond Latin letters and ASCII marks go to the library.
    """

    def __init__(self, name: str):
        import tiktoken
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        end = model["end_of_word_suffix"]
        raw = lambda t: bytes(map(_BYTE_OF.__getitem__, t.removesuffix(end))) + (b"\0" if t.endswith(end) else b"")
        order = [*(c for c in _BYTE_OF), *(c + end for c in _BYTE_OF)]
        order += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ranks: dict[bytes, int] = {}
        for token in order:
            ranks.setdefault(raw(token), len(ranks))
        ids = {raw(t): k for t, k in model["vocab"].items() if set(t.removesuffix(end)) <= _BYTE_OF.keys()}
        self.id_of = np.array([ids[token] for token in ranks], dtype="<u4")
        self.fast = tiktoken.Encoding("words", pat_str="[^\\x00\\n]+\\x00|\\n", mergeable_ranks=ranks, special_tokens={})
        self.line_end = ranks[b"\n"]
        self.forget()

    def forget(self) -> None:
        """Only the empty word is known; it has no ids."""
        self.words = pa.array([""], pa.large_string())
        self.ids = np.zeros(0, dtype="<u4")
        self.lengths = np.zeros(1, np.int64)

    def direct(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of Latin letters and ASCII marks, one word after the other, and how many each word has."""
        if not len(words):
            return np.zeros(0, dtype="<u4"), np.zeros(0, np.int64)
        pieces = pc.replace_substring_regex(pc.utf8_lower(words), _PIECE, "\\0\x00")
        lines = pc.binary_join(pa.scalar(pieces.to_pylist(), pa.list_(pa.large_string())), pa.scalar("\n", pa.large_string())).as_py()
        found = self.fast.encode_to_numpy(lines, disallowed_special=())
        line = found == self.line_end
        ends = np.append(np.flatnonzero(line), len(found))
        return self.id_of[found[~line]], np.diff(ends, prepend=-1) - 1

    def batch(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """One array of ids for each text.

        Texts are cut and their words numbered in Arrow, after the words that are known already; what is new is encoded once.
        """
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        own = {k: texts[k].as_py() for k in np.flatnonzero(pc.match_substring_regex(texts, "[\x1c-\x1f]").to_numpy(zero_copy_only=False)).tolist()}
        if own:
            texts = pa.array(["" if k in own else t for k, t in enumerate(texts.to_pylist())], pa.large_string())
        split = pc.utf8_split_whitespace(texts)
        values = split.flatten()
        numbered = pa.concat_arrays([self.words, values]).dictionary_encode()
        at = numbered.indices[len(self.words):].to_numpy(zero_copy_only=False)

        new = numbered.dictionary[len(self.words):]
        latin = pc.match_substring_regex(new, _LATIN).to_numpy(zero_copy_only=False)
        plain_at, odd_at = np.flatnonzero(latin), np.flatnonzero(~latin)
        odd_at = odd_at[np.argsort(pc.utf8_length(new.take(pa.array(odd_at))).to_numpy(), kind="stable")]  # the long ones, which are not kept, last
        plain, odd = new.take(pa.array(plain_at)), new.take(pa.array(odd_at))
        ids, lengths = self._encoded(plain)
        other = [self.direct(w) for w in odd.to_pylist()]
        ids = np.concatenate([self.ids, ids, *other])
        lengths = np.concatenate([self.lengths, lengths, np.array([len(i) for i in other], np.int64)])
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(starts))  # where each word of the dictionary stands now
        place[len(self.words) + np.concatenate([plain_at, odd_at])] = np.arange(len(self.words), len(starts))
        at = place[at]

        size = lengths[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(starts[at] - ends[:-1], size) + np.arange(ends[-1])]
        cut = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        found = [flat[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        for k, text in own.items():
            found[k] = self.direct(text)

        short = int(np.count_nonzero(pc.utf8_length(odd).to_numpy() <= LONGEST))
        kept = len(self.words) + len(plain) + short
        if kept > REMEMBERED:
            self.forget()
        else:
            self.words = pa.concat_arrays([self.words, plain, odd[:short]])
            self.lengths = lengths[:kept]
            self.ids = ids[:int(self.lengths.sum())]
        return found


class ByteCounts:
    """Token counts by a byte-level vocabulary that keeps white space."""

    def __init__(self, name: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path(name))
        with open(tokenizer_path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(
            "counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def count(self, text: str) -> int:
        """The library's count.  The quick encoder has the same vocabulary; it sees only texts on which both agree."""
        if "<|" not in text and _PLAIN.fullmatch(text) and not _LONG_RUN.search(text):
            return len(self.fast.encode_ordinary(text))
        return len(self.library.encode(text, add_special_tokens=False).ids)


_KEPT: dict = {}


def _kept(key: tuple, make):
    """The worker's own instance: Spark reuses Python workers, and with them what they remember."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def word_ids(name: str) -> WordIds:
    return _kept(("ids", name), lambda: WordIds(name))


def byte_counts(name: str, ranks: str) -> ByteCounts:
    return _kept(("counts", name, ranks), lambda: ByteCounts(name, ranks))
