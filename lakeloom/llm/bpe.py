"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled, one *merge gadget* after the other, into a
deterministic automaton whose arcs are labelled with tokens and whose state is
the token read last. Before any merge every byte may follow every byte. The
gadget of merge ``u v -> w`` removes the arc ``v`` after ``u`` and adds a state
``w`` that is entered wherever ``u`` was and left wherever ``v`` was, as the
arcs stood at that moment. A token string is the BPE encoding of its text
exactly when the final automaton accepts it. Every prefix of a word has one
accepted path, so the automaton over bytes that follows is deterministic: it
reads a byte at a time, all distinct words together, and at each place one
token is read last. Its tables are

* transitions over the labels read in part (a tree), each state with a default
  link to the longest shorter state that its bytes end with, taken where a
  state has no transition of its own for a byte;
* of each such state the longest token that ends there, and of each token the
  next shorter one: among these the token read last is the one that has an arc
  from the token read last where it begins.

No step is taken back. Decoding emits the byte labels of the arcs.

The arcs of 50,000 merges are billions, nearly all inherited, so a state keeps
its exceptions only: the removed arcs with the time of removal, the two parts
of each state, its birth. An arc that is no exception is there if the state it
was inherited from had it.

Nulls: a null text encodes as an empty one. Empty text: no tokens. Very long
texts and words take time in proportion to their length. Repeated rows are
encoded each for itself, ties cannot arise. An empty table gives an empty
result. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Longer words are read one by one, as few words have so many bytes.
LONG_WORD = 64
#: Characters encoded together; every distinct word among them is encoded once.
RUN_CHARS = 3_000_000

#: The byte-level pre-tokenizer's pattern (fixed value of the format).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space with white space or nothing on one side.
_SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_SPACE = f"(^|[{_SPACES}]) | ([{_SPACES}]|$)"


def _byte_alphabet() -> dict[str, int]:
    """The byte-level format writes printable bytes as themselves and the rest, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class _Table:
    """Whole-number keys to whole-number values, looked up by arrays; -1 where a key is missing."""

    def __init__(self, items: dict[int, int]):
        bits = max(4, (2 * len(items)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, np.int64)
        self._values = np.full(1 << bits, -1, np.int64)
        keys = np.fromiter(items.keys(), np.int64, len(items))
        values = np.fromiter(items.values(), np.int64, len(items))
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):  # of keys that want one free slot the first gets it, the others go on
            free = self._keys[slot[left]] < 0
            _, one = np.unique(slot[left[free]], return_index=True)
            put = left[free][one]
            self._keys[slot[put]], self._values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        held = self._keys[slot]
        out = np.where(held == keys, self._values[slot], -1)
        left = np.nonzero((held != keys) & (held >= 0))[0]
        while len(left):
            slot[left] = (slot[left] + 1) & self._mask
            held = self._keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = self._values[slot[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


class Automaton:
    """Deterministic tokenization automaton of a list of merges.

    ``base``: token id of each single byte. ``merges``: ``(u, v, w)`` token ids
    by rank. ``labels``: the bytes of each token.
    """

    def __init__(self, base: dict[int, int], merges: list[tuple[int, int, int]], labels: dict[int, bytes]):
        n = max(labels, default=-1) + 1
        self.labels, self._n = labels, n
        self.length = np.array([len(labels.get(i, b"")) for i in range(n)], np.int64)
        self.left, self.right, self.born = np.full(n, -1), np.full(n, -1), np.full(n, -1)
        self.born[list(base.values())] = 0
        removed: dict[int, int] = {}
        for rank, (u, v, w) in enumerate(merges, 1):
            self._gadget(removed, rank, u, v, w)
        self.end_of_time = len(merges) + 1
        self._removed, self._removal_of = _Table(removed), removed
        self._parts = [x.tolist() for x in (self.left, self.right, self.born)]
        self._compile_labels()

    def _gadget(self, removed: dict[int, int], rank: int, u: int, v: int, w: int) -> None:
        if self.born[w] >= 0 or self.born[u] < 0 or self.born[v] < 0:
            raise ValueError(f"merge {rank}: token {w} is made twice, or of tokens not made yet")
        removed[u * self._n + v] = rank
        self.left[w], self.right[w], self.born[w] = u, v, rank
        if u == v:
            # u u u reads as w u: merges go from left to right, so w never follows u.
            removed[u * self._n + w] = rank

    def _compile_labels(self) -> None:
        """Transitions over labels read in part, default links, and the tokens that end at each state."""
        states: dict[bytes, int] = {b"": 0}
        transitions: dict[int, int] = {}
        token_at = {0: -1}
        for token in np.nonzero(self.born >= 0)[0].tolist():
            label = self.labels[token]
            for i in range(1, len(label) + 1):
                if label[:i] not in states:
                    states[label[:i]] = len(states)
                    transitions[states[label[: i - 1]] * 256 + label[i - 1]] = states[label[:i]]
            token_at[states[label]] = token
        self._transitions, self._transition_of = _Table(transitions), transitions
        self._default = np.zeros(len(states), np.int64)
        self._last_token = np.array([token_at.get(i, -1) for i in range(len(states))])
        self._next_token = np.full(self._n, -1)
        for label, state in sorted(states.items(), key=lambda x: len(x[0])):
            shorter = (states.get(label[k:]) for k in range(1, len(label)))
            self._default[state] = default = next((x for x in shorter if x is not None), 0)
            token = self._last_token[state]
            if token >= 0:
                self._next_token[token] = self._last_token[default]
            elif state:
                self._last_token[state] = self._last_token[default]
        self._lists = [x.tolist() for x in (self._default, self._last_token, self._next_token, self.length)]

    def arcs(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether the automaton has arc ``t`` at state ``s``, for arrays of both."""
        s, t = s.copy(), t.copy()
        time = np.full(len(s), self.end_of_time)
        stands, left = np.ones(len(s), bool), np.arange(len(s))
        while len(left):
            a, b = s[left], t[left]
            gone = self._removed.get(a * self._n + b)
            gone = (gone >= 0) & (gone < time[left])
            stands[left[gone]] = False
            born_a, born_b = self.born[a], self.born[b]
            on = ~gone & ((born_a > 0) | (born_b > 0))
            left, a, b, born_a, born_b = left[on], a[on], b[on], born_a[on], born_b[on]
            # The state made last was entered where its left part was, and left where its right part was.
            time[left] = np.maximum(born_a, born_b)
            t[left] = np.where(born_b >= born_a, self.left[b], b)
            s[left] = np.where(born_a >= born_b, self.right[a], a)
        return stands

    def _arc(self, s: int, t: int) -> bool:
        """:meth:`arcs` of one pair."""
        left, right, born = self._parts
        time = self.end_of_time
        while True:
            gone = self._removal_of.get(s * self._n + t)
            if gone is not None and gone < time:
                return False
            born_s, born_t = born[s], born[t]
            if born_s <= 0 and born_t <= 0:
                return True
            time = max(born_s, born_t)
            s, t = right[s] if born_s >= born_t else s, left[t] if born_t >= born_s else t

    def _read_long(self, word: bytes) -> list[int]:
        """The token read last at each place of a word after its first."""
        default, last_token, next_token, length = self._lists
        came, state = [-1], 0
        for read, byte in enumerate(word, 1):
            while (found := self._transition_of.get(state * 256 + byte)) is None and state:
                state = default[state]
            state = found or 0
            token = last_token[state]
            while token >= 0 and (began := read - length[token]) and not self._arc(came[began], token):
                token = next_token[token]
            if token < 0:
                raise ValueError("no accepted path: a byte has no token")
            came.append(token)
        return came[1:]

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """States after one more byte; along default links where a state has no transition for it."""
        state = state.copy()
        found = self._transitions.get(state * 256 + byte)
        left = np.flatnonzero((found < 0) & (state > 0))
        while len(left):
            state[left] = self._default[state[left]]
            found[left] = self._transitions.get(state[left] * 256 + byte[left])
            left = left[(found[left] < 0) & (state[left] > 0)]
        return np.maximum(found, 0)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words one after the other, and how many each word has.
        All words take a byte at a time together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        # One byte between words gives each its own end place.
        first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        end = first + sizes
        if not len(words):
            return np.zeros(0, np.uint32), sizes
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
        # The token read last at each place; words from long to short, so that those still read come first.
        came = np.full(len(data), -1)
        by_size = np.argsort(-sizes, kind="stable")
        starts, falling = first[by_size], -sizes[by_size]
        for w in by_size[: np.searchsorted(falling, -LONG_WORD, side="left")].tolist():
            came[first[w] + 1 : end[w] + 1] = self._read_long(words[w])
        starts, falling = (x[np.searchsorted(falling, -LONG_WORD, side="left") :] for x in (starts, falling))
        state = np.zeros(len(starts), np.int64)
        for read in range(1, -int(falling[0]) + 1 if len(falling) else 1):
            n = int(np.searchsorted(falling, -read, side="right"))
            state = self._step(state[:n], data[starts[:n] + read - 1])
            token, left = self._last_token[state], np.arange(n)
            while len(left):
                if (token[left] < 0).any():
                    raise ValueError("no accepted path: a byte has no token")
                began = read - self.length[token[left]]
                ok = began == 0
                inner = np.flatnonzero(~ok)
                ok[inner] = self.arcs(came[starts[left[inner]] + began[inner]], token[left[inner]])
                came[starts[left[ok]] + read] = token[left[ok]]
                left = left[~ok]
                token[left] = self._next_token[token[left]]
        # Read the paths from their ends.
        steps, at, active = [], end.copy(), np.nonzero(sizes > 0)[0]
        counts = np.zeros(len(words), np.int64)
        while len(active):
            t = came[at[active]]
            steps.append((active, t))
            counts[active] += 1
            at[active] -= self.length[t]
            active = active[at[active] > first[active]]
        out, back = np.empty(int(counts.sum()), np.uint32), np.cumsum(counts)
        for words_here, t in steps:
            back[words_here] -= 1
            out[back[words_here]] = t
        return out, counts


class ByteLevelBPE:
    """A byte-level BPE tokenizer file, compiled."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or odd:
            raise ValueError("only plain byte-level BPE files are supported")
        alphabet = _byte_alphabet()
        vocab = model["vocab"]
        labels = {i: bytes(alphabet[c] for c in s) for s, i in vocab.items()}
        base = {alphabet[c]: vocab[c] for c in alphabet if c in vocab}
        merges = []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            merges.append((vocab[a], vocab[b], vocab[a + b]))
        self.automaton = Automaton(base, merges, labels)
        self.added: dict[str, int] = {}
        for x in spec.get("added_tokens") or []:
            if x.get("single_word") or x.get("lstrip") or x.get("rstrip"):
                raise ValueError("added tokens that strip or match single words are not supported")
            self.added[x["content"]] = x["id"]
            labels.setdefault(x["id"], x["content"].encode())
        self._split = regex.compile(BYTE_LEVEL_PATTERN).findall
        self._added = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        # Arc labels by token id.
        self._labels = pa.array([labels.get(i, b"") for i in range(max(labels, default=-1) + 1)], pa.large_binary())

    def _words_of(self, unit: str) -> list[str]:
        """The pre-split words of a unit. Strings of added tokens are words of their own."""
        if self._added is not None and any(x in unit for x in self.added):
            return [w for part in self._added.split(unit) if part for w in ([part] if part in self.added else self._split(part))]
        return self._split(unit)

    def _encode_units(self, units: list[str]) -> pa.Array:
        """Packed ids of each unit; every distinct word is encoded once."""
        words, per_unit = [], np.zeros(len(units), np.int64)
        for i, unit in enumerate(units):
            if unit.isalpha() or (unit[:1] == " " and unit[1:].isalpha()):
                words.append(unit)
                per_unit[i] = 1
            else:
                found = self._words_of(unit)
                words += found
                per_unit[i] = len(found)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        ids, counts = self.automaton.encode_words([b"" if w in self.added else w.encode() for w in distinct])
        rows = _rows(ids, counts)
        if self.added:
            special = pa.array([self.added[w].to_bytes(4, "little") if w in self.added else None for w in distinct], pa.large_binary())
            rows = pc.coalesce(special, rows)
        return _joined(rows.take(coded.indices), per_unit)

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        """Packed ids of each text.

        The pattern always starts a word at a space between two non-spaces, so
        most texts fall into units at their spaces, and distinct units are split
        into words once. Texts with other spaces, or with strings of added
        tokens, are one unit each.
        """
        texts = texts.cast(pa.large_string())
        whole = pc.match_substring_regex(texts, ODD_SPACE)
        for x in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, x))
        plain = texts.filter(pc.invert(whole))
        split = pc.split_pattern(plain, " ")
        starts = split.offsets.to_numpy()
        coded = split.values.slice(int(starts[0]), int(starts[-1] - starts[0])).dictionary_encode()
        first = coded.dictionary.take(coded.indices.take(pa.array(starts[:-1] - starts[0]))).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        # Units after a space have it in front; the first unit of a text has none.
        code[starts[:-1] - starts[0]] = first.indices.to_numpy() + len(coded.dictionary)
        rest = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), coded.dictionary, pa.scalar(" ", pa.large_string()))
        units = [*rest.to_pylist(), *first.dictionary.to_pylist()]
        packed = _joined(self._encode_units(units).take(pa.array(code)), np.diff(starts))
        odd = self._encode_units(texts.filter(whole).to_pylist())
        place = np.argsort(whole.to_numpy(zero_copy_only=False), kind="stable")
        return pa.concat_arrays([packed, odd]).take(pa.array(np.argsort(place, kind="stable")))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch(pa.array([text]))[0].as_py(), np.uint32).tolist()

    def decode_batch(self, packed: pa.Array) -> list[str]:
        """The labels of each text's ids, as UTF-8 (U+FFFD for what is not)."""
        counts = pc.binary_length(packed).to_numpy() // 4
        ids = np.frombuffer(_bytes(packed), np.uint32)
        return [x.decode("utf-8", "replace") for x in _joined(self._labels.take(pa.array(ids)), counts).to_pylist()]


def _rows(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of ids as an array of byte strings."""
    offsets = np.concatenate([[0], np.cumsum(counts * 4)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, np.uint32))])


def _offsets(rows: pa.Array) -> np.ndarray:
    return np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1] if len(rows) else np.zeros(1, np.int64)


def _bytes(rows: pa.Array) -> memoryview:
    """All byte strings one after the other."""
    at = _offsets(rows)
    return memoryview(rows.buffers()[2])[at[0] : at[-1]] if at[-1] > at[0] else memoryview(b"")


def _joined(rows: pa.Array, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of byte strings, each made one."""
    at = _offsets(rows)
    offsets = (at - at[0])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_bytes(rows))])


@lru_cache(maxsize=2)
def load(path: str) -> ByteLevelBPE:
    """One compiled automaton per worker process and file."""
    return ByteLevelBPE(path)


ENCODED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded", T.StringType()),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer_path: str) -> Iterator[tuple[pa.Array, list[bytes], list[str]]]:
    """Ids of the rows, packed token ids and decoded texts, in runs of about ``RUN_CHARS``."""
    bpe = load(tokenizer_path)
    for batch in batches:
        chars = np.cumsum(pc.utf8_length(batch.column(1)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(chars, (chars[start - 1] if start else 0) + RUN_CHARS, "right")))
            part = batch.slice(start, end - start)
            packed = bpe.encode_batch(part.column(1))
            yield part.column(0), packed.to_pylist(), bpe.decode_batch(packed)
            start = end


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids (little-endian uint32), n_tokens, decoded`` of every text. Scan-only: no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, packed, decoded in _encoded(batches, tokenizer_path):
            columns = [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([doc_id, *columns], names=ENCODED.names)

    return _texts(docs, id_col, text_col).mapInArrow(run, ENCODED)


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, packed, decoded in _encoded(batches, tokenizer_path):
            columns = [pa.array([len(p) // 4 for p in packed], pa.int64()), *(pa.array([hashlib.sha256(x).hexdigest() for x in c], pa.string()) for c in (packed, (d.encode() for d in decoded)))]
            yield pa.RecordBatch.from_arrays([doc_id, *columns], names=DIGESTS.names)

    return _texts(docs, id_col, text_col).mapInArrow(run, DIGESTS)
