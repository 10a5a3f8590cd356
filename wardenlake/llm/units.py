"""Token ids and counts of texts, equal to those of the library, with each distinct piece of text encoded once.

For a byte-level tokenizer that splits with its built-in pattern, a text falls apart in front of every space that a
printable character follows: the pattern has no look-behind, only ``\\s+`` alternatives can hold a space that is not
their first character, and those give back the last white space in front of a printable character. So the
ids of a text are the ids of these units in turn, and a unit that was seen before need not be encoded again. For the same
reason a text falls apart between a letter or digit and the punctuation behind it, where a run of either always ends. Texts that
hold the string of an added token go to the library whole, as do all texts of other kinds of tokenizers.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import shingles as sh

#: Distinct units a worker remembers, places of its table, and the longest unit that is remembered (bytes).
REMEMBERED, PLACES, LONGEST = 500_000, 1 << 20, 64

#: Units that are encoded in one call, and units that are looked up at once.
CALL, TOGETHER = 2048, 1 << 15

#: First bytes of characters that are no white space in any reading: printable ASCII and U+00C0 to U+023F.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xC9] = True
#: ASCII letters and digits, and ASCII punctuation.
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[0x21:0x7F] = ~_ALNUM[0x21:0x7F]
#: Text in which letters, digits and white space are beyond doubt, and its pre-tokens.
_PLAIN = re.compile(r"[ \n!-~À-ÖØ-öø-ɏ]*").fullmatch
_PRE_TOKENS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+"
    r"| ?[^ \n0-9A-Za-zÀ-ÖØ-öø-ɏ]+|[ \n]+(?![^ \n])|[ \n]+"
).findall


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str):
    """A ``tokenizers`` tokenizer without truncation and padding, and the strings of its added tokens."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}


def splits_into_units(path: str) -> bool:
    """Whether the tokenizer of a .json file is byte-level with the built-in pattern and nothing else."""
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    pre = kind.get("pre_tokenizer") or {}
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    return bool(byte_level) and kind.get("normalizer") is None


def prove_whole_tokens(path: str) -> list[str]:
    """Vocabulary strings of a byte-level tokenizer that are one pre-token and encode alone as their one id.

    Run once, before the job: every string of the vocabulary is encoded, so the result is bounded by the vocabulary.
    """
    if not splits_into_units(path):
        return []
    tokenizer, added = load(path)
    alphabet, proven = byte_alphabet(), []
    for string, number in tokenizer.get_vocab().items():
        try:
            text = bytes(alphabet[c] for c in string).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if text in added or not _PLAIN(text) or _PRE_TOKENS(text) != [text]:
            continue
        if tokenizer.encode(text, add_special_tokens=False).ids == [number]:
            proven.append(text)
    return sorted(proven)


class Memory:
    """Remembered units: their bytes, numbers of tokens and ids, found by a hash of the bytes.

    Everything lies in arrays. A unit counts as found only if its bytes agree.
    """

    def __init__(self):
        self.keys = np.zeros(PLACES, np.uint64)
        self.index = np.zeros(PLACES, np.int32)
        self.clear()

    def clear(self) -> None:
        self.keys.fill(0)
        self.size = 0
        self.counts = np.zeros(0, np.int64)  # tokens of every unit
        self.ids, self.id_start = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.text, self.text_start = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)  # 0: not in the table
        self.used = np.zeros(0, bool)  # found again since the last time units were forgotten
        self.id_size = self.text_size = 0

    def forget(self) -> None:
        """Forget the units that were not found again."""
        stay = np.flatnonzero(self.used[: self.size] & (self.hash[: self.size] != 0))
        if len(stay) > REMEMBERED // 2:
            stay = stay[-(REMEMBERED // 2) :]
        counts, lengths, keys = self.counts[stay], self.lengths[stay], self.hash[stay]
        ids = taken(self.ids, self.id_start[stay], counts) if self.id_size else self.ids[:0]
        text = taken(self.text, self.text_start[stay], lengths)
        self.clear()
        self.enter(keys, self.append(counts, ids, lengths, text))

    @staticmethod
    def _grown(column: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
        if used + len(more) > len(column):
            column = np.concatenate([column[:used], np.zeros(max(len(more), used // 2, 4096), column.dtype)])
        column[used : used + len(more)] = more
        return column

    def append(self, counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Add units and return their numbers; they are not found before ``enter``."""
        at = np.arange(self.size, self.size + len(counts))
        self.counts = self._grown(self.counts, self.size, counts)
        self.lengths = self._grown(self.lengths, self.size, lengths)
        self.hash = self._grown(self.hash, self.size, np.zeros(len(counts), np.uint64))
        self.used = self._grown(self.used, self.size, np.zeros(len(counts), bool))
        self.id_start = self._grown(self.id_start, self.size, self.id_size + np.cumsum(counts) - counts)
        self.text_start = self._grown(self.text_start, self.size, self.text_size + np.cumsum(lengths) - lengths)
        self.ids = self._grown(self.ids, self.id_size, ids)
        self.text = self._grown(self.text, self.text_size, text)
        self.size += len(counts)
        self.id_size += len(ids)
        self.text_size += len(text)
        return at

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the units with these hashes, or -1."""
        out, open_at, place = np.full(len(keys), -1, np.int64), np.arange(len(keys)), (keys & np.uint64(PLACES - 1)).astype(np.int64)
        while len(open_at):
            held = self.keys[place]
            hit = held == keys[open_at]
            out[open_at[hit]] = self.index[place[hit]]
            on = ~hit & (held != 0)
            open_at, place = open_at[on], (place[on] + 1) & (PLACES - 1)
        return out

    def enter(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Make units that are not in the table found by their hashes (all different)."""
        self.hash[numbers] = keys
        open_at, place = np.arange(len(keys)), (keys & np.uint64(PLACES - 1)).astype(np.int64)
        while len(open_at):
            free = np.flatnonzero(self.keys[place] == 0)
            slot, first = np.unique(place[free], return_index=True)
            chosen = free[first]
            self.keys[slot] = keys[open_at[chosen]]
            self.index[slot] = numbers[open_at[chosen]]
            left = np.ones(len(open_at), bool)
            left[chosen] = False
            open_at, place = open_at[left], (place[left] + 1) & (PLACES - 1)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the spans, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def taken(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of a buffer, one after the other. Positions are made for some spans at a time: they take more room."""
    parts = [data[:0]]
    for at in range(0, len(starts), TOGETHER):
        parts.append(data[spans(starts[at : at + TOGETHER], lengths[at : at + TOGETHER])])
    return np.concatenate(parts)


def unit_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of the bytes of every unit, never 0. All units have a byte."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    power = np.full(int(lengths.max()), sh._BASE, np.uint64)
    power[0] = np.uint64(1)
    power = np.cumprod(power, dtype=np.uint64)
    place = spans(np.zeros(len(lengths), np.int64), lengths)
    value = sh._BYTE[data[spans(starts, lengths)]] * power[place]
    return np.maximum(sh.mix(np.add.reduceat(value, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64)), np.uint64(1))


def same_bytes(one: np.ndarray, starts: np.ndarray, two: np.ndarray, others: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of two buffers with equal lengths hold the same bytes."""
    if not len(lengths):
        return np.zeros(0, bool)
    differs = one[spans(starts, lengths)] != two[spans(others, lengths)]
    return np.add.reduceat(differs.astype(np.int64), np.cumsum(lengths) - lengths) == 0


def breaks(data: np.ndarray) -> np.ndarray:
    """Where punctuation follows a letter or digit: ASCII, or a letter of U+00C0 to U+023F."""
    ends = _ALNUM[data]
    lead, last = data[:-1], data[1:]
    ends[1:] |= (lead >= 0xC3) & (lead <= 0xC8) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    out = np.zeros(len(data), bool)
    out[1:] = ends[:-1] & _PUNCTUATION[last]
    return out


class Encoder:
    """Token ids of whole texts. ``keep_ids=False`` keeps their numbers only."""

    def __init__(self, path: str, keep_ids: bool = True):
        self.tokenizer, self.added = load(path)
        self.in_units, self.keep_ids = splits_into_units(path), keep_ids
        vocabulary = self.tokenizer.get_vocab() if self.in_units else {}
        self.token_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for string, number in vocabulary.items():
            self.token_bytes[number] = len(string)
        self.memory = Memory() if self.in_units else None

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens and ids of texts, one after the other, from the library."""
        ids = []
        for at in range(0, len(texts), 64):  # the library's results are far larger than their ids
            found = self.tokenizer.encode_batch_fast(texts[at : at + 64], add_special_tokens=False)
            ids += [np.array(e.ids, np.uint32) for e in found]
        return np.array([len(i) for i in ids], np.int64), np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    def joined(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for units that begin a pre-token behind any text: many are encoded in one text, which is cut again
        where the bytes of the tokens reach the end of a unit."""
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for at in range(0, len(units), CALL):
            group = units[at : at + CALL]
            (encoded,) = self.tokenizer.encode_batch_fast([b"".join(group).decode()], add_special_tokens=False)
            got = np.array(encoded.ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
            cuts = np.searchsorted(np.cumsum(self.token_bytes[got]), ends, "left") + 1
            counts.append(np.diff(cuts, prepend=0))
            ids.append(got)
        return np.concatenate(counts), np.concatenate(ids)

    def work_out(self, units: list[bytes], joinable: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens and ids of new units, of which the first ``joinable`` may be joined."""
        counts, ids = self.joined(units[:joinable])
        more, rest = self.whole([u.decode() for u in units[joinable:]])
        return np.concatenate([counts, more]), np.concatenate([ids, rest])

    def _numbers(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, joinable: np.ndarray) -> np.ndarray:
        """Numbers in the memory of units; new ones are worked out. Long units are appended but not remembered."""
        memory, out = self.memory, np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= LONGEST)
        keys = unit_hashes(data, starts[short], lengths[short])
        found = memory.find(keys)
        known = np.flatnonzero(found >= 0)
        known = known[memory.lengths[found[known]] == lengths[short[known]]]
        at, numbers = short[known], found[known]
        equal = same_bytes(data, starts[at], memory.text, memory.text_start[numbers], lengths[at])
        out[at[equal]] = numbers[equal]
        memory.used[numbers[equal]] = True

        unknown = np.flatnonzero(found < 0)
        fresh, first, back = np.unique(keys[unknown], return_index=True, return_inverse=True)
        first, unknown = short[unknown[first]], short[unknown]
        alike = np.flatnonzero(lengths[unknown] == lengths[first][back])
        alike = alike[same_bytes(data, starts[unknown[alike]], data, starts[first[back[alike]]], lengths[unknown[alike]])]
        pending = np.full(len(starts), -1, np.int64)
        pending[unknown[alike]] = back[alike]
        # long units, and units whose hash another unit took, are worked out here and not remembered
        other = np.flatnonzero((out < 0) & (pending < 0))
        new = np.concatenate([first, other])
        if len(new):
            order = np.argsort(~joinable[new], kind="stable")
            units = [data[a : a + n].tobytes() for a, n in zip(starts[new[order]].tolist(), lengths[new[order]].tolist(), strict=True)]
            counts, ids = self.work_out(units, int(joinable[new].sum()))
            text = np.frombuffer(b"".join(units), np.uint8)
            numbers = np.empty(len(new), np.int64)
            numbers[order] = memory.append(counts, ids if self.keep_ids else ids[:0], lengths[new[order]], text)
            memory.enter(fresh, numbers[: len(first)])
            waiting = np.flatnonzero(pending >= 0)
            out[waiting] = numbers[pending[waiting]]
            out[other] = numbers[len(first) :]
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """First token of every row (one entry more than rows) and the ids of all rows; null reads as empty.

        Without ``keep_ids`` the second is empty.
        """
        column = column.cast(pa.string()).fill_null("") if column.null_count else column
        if not self.in_units:
            counts, ids = self.whole(column.to_pylist())
            return np.concatenate([[0], np.cumsum(counts)]), ids
        special = np.zeros(len(column), bool)
        for string in self.added:
            special |= pc.match_substring(column, string).to_numpy(zero_copy_only=False)
        if special.any():
            return self._encode_mixed(column, special)
        data, offsets = sh.buffers(column)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if not len(data):
            return np.zeros(len(offsets), np.int64), np.zeros(0, np.uint32)
        solid = _SOLID[data]
        joins = np.zeros(len(data), bool)
        joins[:-1] = ((data[:-1] == 0x20) | (data[:-1] == 0x0A)) & solid[1:]
        joins[offsets[1:-1][offsets[1:-1] > 0] - 1] = False  # the solid byte belongs to the next row
        begins = joins | breaks(data)
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(starts, append=len(data))
        joinable = joins[starts]
        counts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for at in range(0, len(starts), TOGETHER):
            part = slice(at, at + TOGETHER)
            if self.memory.size > REMEMBERED:
                self.memory.forget()
            numbers = self._numbers(data, starts[part], lengths[part], joinable[part])
            counts.append(self.memory.counts[numbers])
            if self.keep_ids:
                ids.append(self.memory.ids[spans(self.memory.id_start[numbers], counts[-1])])
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return ends[np.searchsorted(starts, offsets, "left")], np.concatenate(ids)

    def _encode_mixed(self, column: pa.Array, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows with the string of an added token go to the library whole."""
        first, ids = self.encode(pc.if_else(pa.array(special), pa.scalar("", column.type), column))
        more, rest = self.whole(column.filter(pa.array(special)).to_pylist())
        counts = np.diff(first)
        counts[special] = more
        start = first[:-1].copy()
        start[special] = len(ids) + np.cumsum(more) - more
        out = np.concatenate([ids, rest])[spans(start, counts)] if self.keep_ids else ids
        return np.concatenate([[0], np.cumsum(counts)]), out


class Counter(Encoder):
    """Numbers of tokens of whole texts: pre-tokens proven to be one token are counted, only the rest is merged."""

    def __init__(self, path: str, whole_tokens: list[str]):
        super().__init__(path, keep_ids=False)
        self.proven = frozenset(whole_tokens)

    def work_out(self, units: list[bytes], joinable: int) -> tuple[np.ndarray, np.ndarray]:
        counted, rest = np.zeros(len(units), np.int64), []
        for number, raw in enumerate(units):
            unit = raw.decode()
            parts = [unit] if unit in self.proven else _PRE_TOKENS(unit) if _PLAIN(unit) else [unit]
            for part in parts:
                if part in self.proven:
                    counted[number] += 1
                else:
                    rest.append((number, part.encode()))
        # a part with a leading space begins a pre-token behind any text; the others are merged alone
        rest.sort(key=lambda r: r[1][:1] != b" " or not _SOLID[r[1][1:2][0] if r[1][1:2] else 0x20])
        behind = sum(1 for _, p in rest if p[:1] == b" " and p[1:2] and _SOLID[p[1]])
        merged, ids = super().work_out([p for _, p in rest], behind)
        np.add.at(counted, np.array([n for n, _ in rest], np.int64), merged)
        return counted, ids

    def count(self, column: pa.Array) -> np.ndarray:
        """Numbers of tokens of every row; null reads as empty."""
        return np.diff(self.encode(column)[0])


class SentencePieceCounter:
    """Numbers of pieces of whole texts with a .model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, column: pa.Array) -> np.ndarray:
        return np.array([len(ids) for ids in self.processor.encode([t or "" for t in column.to_pylist()], num_threads=1)], np.int64)
