"""Token ids of whole Arrow batches: texts are cut where no token can reach across, and each distinct cut is encoded once.

Encoding is most of the cost of a tokenizer library, and a corpus repeats its words: a batch has few distinct ones. The
cuts are places where the tokenizer's own rules start afresh, so the ids are those of the whole texts.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trawlnet.llm.token_counts import WORD_PATTERN, Tokenizer, _byte_of, _plain_byte_level
from trawlnet.llm.words import LOWER

Encode = Callable[[list[str]], list[list[int]]]
EncodeAll = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

#: Pieces of up to so many characters are remembered from batch to batch, up to so many of them.
KNOWN_CHARS, KNOWN = 48, 300_000
#: Words that are not plain, where plain ones need no memory.
KNOWN_ODD = 50_000

# The split of vocabularies with word ends, whose tokens hold no white space.
WORD_END_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK = "▁"

#: Ends a word in front of the merges; no printable character.
END = "\0"
#: Longer words go to the library, whose merges take less than quadratic time.
PLAIN_BYTES = 256

# In UTF-8, plain words hold printable ASCII but the bracket that begins special strings, and the letters from U+00C0 to
# U+00FF: that lead byte, and later bytes, which follow another lead only in words that are not plain.
_LEAD = 0xC3
_PLAIN = [*range(0x21, ord("<")), *range(ord("<") + 1, 0x7F), *range(0x80, 0xC0), _LEAD]
_ODD = np.ones(256, dtype=bool)
_ODD[_PLAIN] = False
_LETTER, _DIGIT, _SIGN = 0, 1, 2
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), _LEAD]] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_SHORT = np.zeros(256, dtype=bool)
_SHORT[[ord(c) for c in "stmd"]] = True

#: First bytes of characters outside ASCII that may be white space; a cut is not made before those.
_MAYBE_BLANK = np.zeros(256, dtype=bool)
_MAYBE_BLANK[[*range(0x09, 0x0E), 0x20, 0xC2, 0xE1, 0xE2, 0xE3]] = True


def large(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_string()).fill_null("")


def contents(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings and the n + 1 places where they begin and end."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def slices(raw: np.ndarray, places: np.ndarray) -> pa.Array:
    """The texts between neighbouring places."""
    places = np.ascontiguousarray(places, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(raw))])


class Remembered:
    """The ids of texts, one after another, and how many each has. Short texts are encoded once per task while their
    number is within bounds; then they are forgotten, so memory is bounded and the ids stay the same."""

    def __init__(self, encode: Encode, most: int = KNOWN):
        self.encode, self.most, self.known = encode, most, {}

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.most:
            self.known.clear()
        texts = pieces.to_pylist()
        ids = list(map(self.known.get, texts))
        new = [i for i, own in enumerate(ids) if own is None]
        for i, own in zip(new, self.encode([texts[i] for i in new]), strict=True):
            ids[i] = array("i", own).tobytes()
            if len(texts[i]) <= KNOWN_CHARS:
                self.known[texts[i]] = ids[i]
        return np.frombuffer(b"".join(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def expand(pieces: pa.Array, owners: np.ndarray, n: int, encode: EncodeAll) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``pieces`` in order and how many each of ``n`` owners has; equal pieces are encoded once."""
    coded = pieces.dictionary_encode()
    flat, sizes = encode(coded.dictionary)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64()), pa.array(flat))
    every = lists.take(coded.indices)
    # list flatten and parent indices give each id its piece, and the piece its owner
    parents = pc.list_parent_indices(every).to_numpy()
    return every.flatten().to_numpy(), np.bincount(owners[parents], minlength=n) if len(parents) else np.zeros(n, np.int64)


def word_starts(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where texts begin and where a single space leads to a word: before a space between two other characters, the one
    after it being no white space. Places of the pieces, n + 1."""
    if not len(raw):
        return places[:1]
    space = raw == 0x20
    cut = np.zeros(len(raw), dtype=bool)
    cut[1:-1] = space[1:-1] & ~space[:-2] & ~_MAYBE_BLANK[raw[2:]]
    # neither across the end of a text nor in its first character
    ends = places[1:-1]
    cut[ends - 1] = False
    cut[places[:-1][np.diff(places) > 0]] = True
    return np.concatenate([np.flatnonzero(cut), [len(raw)]])


def quiet() -> None:
    """Tasks run side by side already; the library's own threads would only compete with them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def json_library(data: bytes, plain_specials: bool = False):
    quiet()
    from tokenizers import Tokenizer as Library

    library = Library.from_str(data.decode())
    library.no_truncation()
    library.no_padding()
    library.encode_special_tokens = plain_specials
    return library


def json_encoder(data: bytes, plain_specials: bool = False) -> Encode:
    library = json_library(data, plain_specials)
    return lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def _ends_alone(ranks: dict[str, int], made: dict[str, tuple[str, str]]) -> bool:
    """Whether joining neighbours whose text is the lowest-ranked entry makes every entry of its own two parts.

    A pair that no merge lists could be joined only where its text, taken alone, falls into those two parts; if every
    entry falls into the parts of its one merge, joining by text and joining by merges are the same.
    """
    none = len(ranks)
    for token, parts in made.items():
        own = [*token[:-2], token[-2:]] if token.endswith(END) else list(token)
        while len(own) > 2:
            rank = [ranks.get(x + y, none) for x, y in zip(own, own[1:], strict=False)]
            i = rank.index(min(rank))
            if rank[i] == none:
                return False
            own[i : i + 2] = [own[i] + own[i + 1]]
        if tuple(own) != parts:
            return False
    return True


class PlainWords:
    """Ids of words of ASCII and Latin-1 letters by a vocabulary with word ends, all words of a buffer in one call.

    The encoder joins by the rank of the joined bytes. A word's last byte and its end mark come first, so from there on
    the joins are those of the vocabulary, whose order and parts are checked once.
    """

    def __init__(self, spec: dict):
        import tiktoken

        vocab, suffix, byte = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"], _byte_of()
        allowed = {c for c, b in byte.items() if b in set(_PLAIN)}
        names = {}
        for token in vocab:
            stem = token.removesuffix(suffix)
            if stem and allowed.issuperset(stem):
                names[token] = "".join(chr(byte[c]) for c in stem) + END * (stem != token)
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        made = {names[a + b]: (names[a], names[b]) for a, b in pairs if a + b in names}
        alone = [chr(b) for b in _PLAIN]
        order = [*(c + END for c in alone), *alone, *made]
        ranks = {name: i for i, name in enumerate(order)}
        merged = [vocab[a + b] for a, b in pairs]
        rises = all(x < y for x, y in zip(merged, merged[1:], strict=False))
        #: Whether words can be encoded here at all.
        self.fits = rises and len(order) == len(names) and sorted(order) == sorted(names.values()) and _ends_alone(ranks, made)
        if self.fits:
            tokens = {name: token for token, name in names.items()}
            self.ids = np.array([vocab[tokens[name]] for name in order], np.int32)
            self.ends = np.array([name.endswith(END) for name in order])
            raw = {name.encode("latin-1"): rank for name, rank in ranks.items()}
            self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=raw, special_tokens={})

    def odd(self, raw: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which of the words between ``places`` are not plain: other characters in them, too long, or empty."""
        bad = np.append(_ODD[raw], False)
        # among the letters stand two signs
        bad[1:-1] |= (raw[:-1] == _LEAD) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        sizes = np.diff(places)
        return np.bitwise_or.reduceat(bad, places[:-1]) | (sizes > PLAIN_BYTES) | (sizes == 0)

    def __call__(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words that stand one after another in ``raw``, and how many each word has."""
        if not len(sizes):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        low, last = LOWER[raw], np.cumsum(sizes) - 1
        lead = np.flatnonzero(raw[:-1] == _LEAD) + 1
        low[lead[raw[lead] <= 0x9E]] += 0x20
        kind = _KIND[low]
        cut = np.ones(len(low), dtype=bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[:-1])
        cut |= kind == _DIGIT
        cut[last] = True
        self._clip(low, cut, last)
        # an end mark after every cut
        at = np.flatnonzero(cut)
        room = np.ones(len(low) + len(at), dtype=bool)
        room[at + np.arange(1, len(at) + 1)] = False
        marked = np.zeros(len(room), np.uint8)
        marked[room] = low
        ranks = self.encoding.encode_to_numpy(marked.tobytes().decode(), disallowed_special=())
        stops = np.flatnonzero(self.ends[ranks])[np.searchsorted(at, last)] + 1
        return self.ids[ranks], np.diff(stops, prepend=0)

    @staticmethod
    def _clip(low: np.ndarray, cut: np.ndarray, last: np.ndarray) -> None:
        """Cuts around 's, 't, 're, 've, 'm, 'll and 'd, where the apostrophe begins a run of signs."""
        at = np.flatnonzero(low == ord("'"))
        if not len(at):
            return
        left = last[np.searchsorted(last, at)] - at
        begins = (at == 0) | cut[at - 1]
        after = np.concatenate([low, np.zeros(2, np.uint8)])
        one, two = after[at + 1], after[at + 2]
        short = begins & (left >= 1) & _SHORT[one]
        long = begins & (left >= 2) & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        cut[at[short | long]] = False
        cut[at[short] + 1] = True
        cut[at[long] + 2] = True


class WordEnds:
    """Ids of texts by a JSON vocabulary, without added special tokens; special strings inside texts as the library's
    default. Texts are cut at ASCII white space where the file's rules are known to drop it, else encoded whole. Plain
    words go through the merges alone, all distinct ones of a batch in one call; others go through the library."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        self.cut = self._drops_blanks(spec)
        self.library = Remembered(json_encoder(data), KNOWN_ODD)
        plain = PlainWords(spec) if self.cut and self._known_merges(spec["model"]) else None
        self.plain = plain if plain and plain.fits else None

    @staticmethod
    def _known_merges(model: dict) -> bool:
        others = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        return model.get("type", "BPE") == "BPE" and bool(model.get("end_of_word_suffix")) and not any(model.get(k) for k in others)

    @staticmethod
    def _drops_blanks(spec: dict) -> bool:
        steps = (spec.get("normalizer") or {}).get("normalizers", [])
        known = all(s["type"] in ("NFC", "Lowercase") or s == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "} for s in steps)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        drops = split.get("pattern") == {"Regex": WORD_END_SPLIT} and split.get("behavior") == "Removed" and split.get("invert")
        marks = spec.get("added_tokens", ())
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in marks)
        bytes_only = [s.get("use_regex", True) for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if s["type"] == "ByteLevel"] == [False]
        return bool(steps and known and drops and plain and marks and bytes_only and not spec.get("truncation") and not spec.get("padding"))

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in order and how many each has."""
        if not (self.plain and len(words)):
            return self.library(words)
        raw, places = contents(words)
        sizes, odd = np.diff(places), self.plain.odd(raw, places)
        of_odd = np.repeat(odd, sizes)
        counts = np.zeros(len(sizes), np.int64)
        odd_ids, counts[odd] = self.library(words.filter(pa.array(odd)))
        plain_ids, counts[~odd] = self.plain(raw[~of_odd], sizes[~odd])
        of_odd = np.repeat(odd, counts)
        ids = np.empty(len(of_odd), np.int32)
        ids[of_odd], ids[~of_odd] = odd_ids, plain_ids
        return ids, counts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order and how many each has."""
        texts, n = large(texts), len(texts)
        if not self.cut:
            return expand(texts, np.arange(n), n, self.library)
        words = pc.ascii_split_whitespace(texts)
        return expand(words.flatten(), pc.list_parent_indices(words).to_numpy(), n, self._encode)


@lru_cache(maxsize=1)
def word_ends(data: bytes) -> WordEnds:
    """The encoder of a vocabulary, made once per worker: reading and checking the file costs more than a small task."""
    return WordEnds(data)


class ByteTokens:
    """A vocabulary with the bytes of each of its ids, encoding texts that begin with a space, piece by piece."""

    table: pa.Array
    cut: bool
    encode: Remembered

    def __call__(self, raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = word_starts(raw, places) if self.cut else places
        owners = np.searchsorted(places, starts[:-1], side="right") - 1
        return expand(slices(raw, starts), owners, len(places) - 1, self.encode)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids one after another, and how many each has."""
        taken = self.table.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        places = np.frombuffer(offsets, np.int64)[: len(ids) + 1]
        return np.frombuffer(data, np.uint8)[: places[-1]] if len(ids) else np.zeros(0, np.uint8), np.diff(places)


class ByteLevel(ByteTokens):
    """Byte-level BPE from a JSON file; special strings inside texts are plain text."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        byte = _byte_of()
        entries: list[bytes] = []
        vocab = json_library(data).get_vocab(with_added_tokens=True)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        for token, i in sorted(vocab.items(), key=lambda e: e[1]):
            entries += [b""] * (i - len(entries))
            entries.append(token.encode() if token in special else bytes(byte[c] for c in token))
        self.table = pa.array(entries, pa.large_binary())
        self.cut = _plain_byte_level(spec)
        library = json_encoder(data, plain_specials=True)
        self.encode = Remembered(self._by_ranks(entries, special, vocab, library) if self.cut else library)

    @staticmethod
    def _by_ranks(entries: list[bytes], special: set[str], vocab: dict[str, int], library: Encode) -> Encode:
        """The same merges in an encoder that is faster for short texts; what it refuses goes to the library."""
        import tiktoken

        marks = {vocab[t] for t in special}
        ranks = {entry: i for i, entry in enumerate(entries) if i not in marks}
        encoding = tiktoken.Encoding("plain", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            try:
                return encoding.encode_ordinary(text)
            except ValueError:
                return library([text])[0]

        return lambda texts: list(map(encode, texts))


class Pieces(ByteTokens):
    """A sentencepiece model that puts a space before each text: what it encodes is a text without its first space."""

    def __init__(self, data: bytes):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=data)
        entries = []
        for i, piece in enumerate(map(library.id_to_piece, range(library.vocab_size()))):
            entries.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace(BLANK, " ").encode())
        self.table = pa.array(entries, pa.large_binary())
        names = [library.id_to_piece(i) for i in range(library.vocab_size()) if not library.is_control(i)]
        # merges never join a character and a blank after it, so they never cross such a place
        self.cut = not any(BLANK in name.lstrip(BLANK) for name in names)
        blank = [library.piece_to_id(BLANK)]

        def encode(texts: list[str]) -> list[list[int]]:
            # an empty text has no ids, though within a text a last space is one
            ids = library.encode([t[1:] for t in texts], num_threads=1) if texts else []
            return [blank if t == " " else i for t, i in zip(texts, ids, strict=True)]

        self.encode = Remembered(encode)


def tokens_of(tokenizer: Tokenizer) -> ByteTokens:
    """The ids and bytes of a ``.json`` or ``.model`` vocabulary."""
    kinds = {".json": ByteLevel, ".model": Pieces}
    if tokenizer.kind not in kinds:
        raise ValueError(f"the bytes of {tokenizer.kind} tokens are not known")
    return kinds[tokenizer.kind](tokenizer.data)


def by_bytes(batch: pa.RecordBatch, text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        held = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, held + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
