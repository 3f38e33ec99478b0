"""BPE encoding by a deterministic automaton over tokens, and decoding by its arc labels.

Merges are compiled in rank order, one gadget each, starting from the automaton with one state and a
loop for every base symbol. Every arc with one label leads to one state, so an automaton is a state per
label and the set of labels that may leave it. The gadget of ``u v -> w`` lets ``w`` leave wherever ``u``
does, lets ``w`` lead where ``v`` leads, and gives ``u`` a new state, a copy of its old one without the
arc ``v``; for ``u = v`` that copy has no arc ``w`` either, because runs merge from the left. What remains
spells every word by exactly one path, and its arc labels are the tokens that rank-ordered merging gives.

States with the same leaving arcs are one row, labels that leave the same states are one column: the table
is a bit matrix (20 MB for 48,894 merges, 2 MB packed), bounded by the number of merges and not by any data, so it
is broadcast. Every beginning of a word is spelled by one path too, so encoding needs no search: place by place, of
the labels that end there exactly one may follow the path to its own start. All new words of a slice are encoded
together, a place of each at a time: a trie gives the labels that start at every byte, the table the transitions.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import pretokens, shared

# Words kept with their ids by a Python worker; of a full memory the older half goes.
REMEMBERED = 120_000
# Bytes of words encoded together, and of texts whose words are looked up together; a longer one is taken alone.
TOGETHER, SLICE = 1 << 17, 2 << 20
# Tokens after which a batch of ids and decoded texts is handed on, so that only so much is held at a time.
PIECE = 400_000
_PACKED = pa.Codec("zstd", compression_level=3)


class Automaton:
    """Rows and columns of the transition table by token, and the table as bits."""

    def __init__(self, vocabulary: pretokens.Vocabulary):
        self.splitter, self.suffix, self.specials = vocabulary.splitter(), vocabulary.suffix, vocabulary.specials
        self.texts = vocabulary.texts
        self.bytes = {b: c for b, c in enumerate(pretokens.byte_characters())}
        state, column, removed = _gadgets(vocabulary)
        self.ids = {text: vocabulary.ids[text] for text in state}
        self.row, self.column = np.zeros(len(self.texts), np.int32), np.zeros(len(self.texts), np.int32)
        for text, number in self.ids.items():
            self.row[number], self.column[number] = state[text], column[text]
        self.table = np.ascontiguousarray(removed.bytes)
        del removed
        self._trie()

    def __getstate__(self) -> dict:
        """Broadcast with the table packed (2 MB of 20): the driver and the executors keep a broadcast's blocks."""
        return self.__dict__ | {"table": (self.table.shape, _PACKED.compress(pa.py_buffer(self.table), asbytes=True))}

    def __setstate__(self, state: dict) -> None:
        shape, packed = state["table"]
        table = np.frombuffer(_PACKED.decompress(packed, shape[0] * shape[1], asbytes=True), np.uint8).reshape(shape)
        self.__dict__ = state | {"table": table}

    def _trie(self) -> None:
        """Labels by their bytes: children of each node as sorted ``node * 256 + byte``, and the labels that end in it."""
        places = {c: b for b, c in self.bytes.items()}
        children: dict[int, int] = {}
        inner, final, self.length = [-1], [-1], np.zeros(len(self.texts), np.int64)
        for text, number in self.ids.items():
            ended = text.endswith(self.suffix)
            node, body = 0, text[:-len(self.suffix)] if ended else text
            for character in body:
                key = node << 8 | places[character]
                if key not in children:
                    children[key] = len(inner)
                    inner.append(-1)
                    final.append(-1)
                node = children[key]
            (final if ended else inner)[node] = number
            self.length[number] = len(body)
        self.keys = np.array(sorted(children), np.int64)
        self.child = np.array([children[k] for k in self.keys.tolist()], np.int32)
        self.inner, self.final = np.array(inner, np.int32), np.array(final, np.int32)

    def encoder(self) -> Encoder:
        return Encoder(self)


def _gadgets(vocabulary: pretokens.Vocabulary) -> tuple[dict[str, int], dict[str, int], _Bits]:
    """State and column of each token; the matrix is 1 where an arc is missing.

    The first loop names the states and columns each gadget makes, so that the table is allocated in its
    final size; the second carries the gadgets out, on the bits: a byte for each arc would take eight times the
    table's memory of the driver.
    """
    merges = vocabulary.merges
    made = {u + v for u, v in merges}
    base = [text for text in vocabulary.ids if text not in made]
    state, column = _Owners(base), _Owners(base)
    gadgets = []
    for u, v in merges:
        w = u + v
        if u not in state.of or v not in state.of or w in state.of:
            raise ValueError(f"merge {u} {v} does not build on earlier ones")
        state.share(w, v)
        column.share(w, u)
        copies = (state.own(u), column.own(v), column.own(w) if u == v else None)
        gadgets.append((copies, state.of[u], column.of[v], column.of[w] if u == v else None))
    missing = _Bits(state.made, column.made)
    for (row, *columns), at, *labels in gadgets:
        if row:
            missing.copy_row(*row)
        for copy in filter(None, columns):
            missing.copy_column(*copy)
        for label in labels:
            if label is not None:
                missing.set(at, label)
    return state.of, column.of, missing


class _Bits:
    """A matrix of bits; bit k of byte j of a row is its column 8 j + k."""

    def __init__(self, rows: int, columns: int):
        self.bytes = np.zeros((rows, columns + 7 >> 3), np.uint8, order="F")

    def __getitem__(self, place: tuple[int, int]) -> bool:
        row, column = place
        return bool(self.bytes[row, column >> 3] >> (column & 7) & 1)

    def set(self, row: int, column: int) -> None:
        self.bytes[row, column >> 3] |= 1 << (column & 7)

    def copy_row(self, old: int, new: int) -> None:
        self.bytes[new] = self.bytes[old]

    def copy_column(self, old: int, new: int) -> None:
        """Into a column that has no bits yet."""
        self.bytes[:, new >> 3] |= (self.bytes[:, old >> 3] >> (old & 7) & 1) << (new & 7)


class _Owners:
    """Which state (or column) each token has, and how many tokens share one."""

    def __init__(self, base: list[str]):
        self.of, self.sharing, self.made = dict.fromkeys(base, 0), Counter({0: len(base)}), 1

    def share(self, token: str, other: str) -> None:
        self.of[token] = self.of[other]
        self.sharing[self.of[other]] += 1

    def own(self, token: str) -> tuple[int, int] | None:
        """Give the token a state of its own; the copy to make for it, if any."""
        old = self.of[token]
        if self.sharing[old] == 1:
            return None
        self.sharing[old] -= 1
        self.of[token], self.sharing[self.made] = self.made, 1
        self.made += 1
        return old, self.made - 1


class Encoder:
    def __init__(self, automaton: Automaton):
        self.a = automaton
        self.known: dict[str, tuple] = {}

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Labels of the only path that spells each (non-empty) word, and how many they are."""
        a = self.a
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data, ends = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.cumsum(sizes)
        word_of = np.repeat(np.arange(len(words)), sizes)
        begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
        # Labels that start at each byte, those that end a word where it ends.
        found, at, node, length = [], np.arange(len(data)), np.zeros(len(data), np.int64), 0
        while len(at):
            asked = node << 8 | data[at + length]
            place = np.minimum(np.searchsorted(a.keys, asked), len(a.keys) - 1)
            go = a.keys[place] == asked
            at, node, length = at[go], a.child[place[go]].astype(np.int64), length + 1
            last = at + length == end[at]
            label = np.where(last, a.final[node], a.inner[node])
            ok = label >= 0
            found.append((at[ok], label[ok]))
            at, node = at[~last], node[~last]
        start, label = (np.concatenate(x) for x in zip(*found, strict=True))
        upto = start + a.length[label]
        order = np.argsort(upto - begin[start], kind="stable")
        start, label, upto = start[order], label[order], upto[order]
        steps = np.searchsorted((upto - begin[start]), np.arange(1, int(sizes.max()) + 2))
        # A place for each beginning of each word, the empty one first: the row its path has come to, and its last label.
        row, by = np.full(len(data) + len(words), -2, np.int64), np.full(len(data) + len(words), -1, np.int32)
        row[ends - sizes + np.arange(len(words))] = -1
        source, target = start + word_of[start], upto + word_of[start]
        for first, stop in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            came, next_label = row[source[first:stop]], label[first:stop]
            column = a.column[next_label]
            bit = a.table[np.maximum(came, 0), column >> 3] >> (column & 7).astype(np.uint8) & 1
            go = np.flatnonzero((came == -1) | (came >= 0) & (bit == 0))
            reached = target[first:stop][go]
            row[reached], by[reached] = a.row[next_label[go]], next_label[go]
        now, number, out, owners = ends + np.arange(len(words)), np.arange(len(words)), [], []
        if (by[now] < 0).any():
            raise ValueError(f"no path spells {words[int(np.flatnonzero(by[now] < 0)[0])]!r}")
        while len(now):                                  # from the last label back
            out.append(by[now])
            owners.append(number)
            now = now - a.length[out[-1]]
            more = by[now] >= 0
            now, number = now[more], number[more]
        labels, owner = np.concatenate(out[::-1]), np.concatenate(owners[::-1])
        return labels[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def learn(self, words: set[str], as_text: bool) -> None:
        """Remember the words as (number of ids, ids, labels as text); ids as text or as bytes of int32."""
        known = self.known
        new = sorted((w for w in words if w not in known), key=len)
        if len(known) + len(new) > REMEMBERED:
            kept = dict(islice(known.items(), len(known) // 2, None))
            kept.update((w, known[w]) for w in words if w in known)
            self.known = known = kept
        places = [w in self.a.specials for w in new]
        plain = [w for w, special in zip(new, places, strict=True) if not special]
        at = 0
        while at < len(plain):
            end, size = at, 0
            while end < len(plain) and (end == at or size < TOGETHER):
                size += len(plain[end])
                end += 1
            labels, counts = self.encode_words([w.encode() for w in plain[at:end]])
            self._keep(plain[at:end], labels, counts.tolist(), as_text)
            at = end
        special = [w for w, special in zip(new, places, strict=True) if special]
        self._keep(special, np.array([self.a.specials[w] for w in special], np.int32), [1] * len(special), as_text)

    def _keep(self, words: list[str], labels: np.ndarray, counts: list[int], as_text: bool) -> None:
        ids, raw = labels.tolist(), labels.astype(np.int32).tobytes()
        named, first = list(map(self.a.texts.__getitem__, ids)), 0
        numbers = list(map(str, ids)) if as_text else None
        for word, n in zip(words, counts, strict=True):
            end = first + n
            self.known[word] = n, " ".join(numbers[first:end]) if as_text else raw[4 * first:4 * end], " ".join(named[first:end])
            first = end

    def batch(self, texts: list[str | None], as_text: bool = False):
        """For each text the remembered entries of its words, in order."""
        split = [self.a.splitter.words(t) for t in texts]
        self.learn(set().union(*split), as_text)
        for found in split:
            yield list(map(self.known.__getitem__, found))

    def text(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join([x[1] for x in next(self.batch([text]))]), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The arc labels, parted by blanks: the form of a tokenizer file without a decoder."""
        return " ".join(map(self.a.texts.__getitem__, ids))


def _text_encoder(automaton: Automaton) -> Encoder:
    """Its memory holds ids as text and must not serve the other form."""
    return Encoder(automaton)


def compile(path: str) -> Automaton:  # noqa: A001
    return Automaton(pretokens.read(path))


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """Each text's token ids and their decoded text.

    Returns ``doc_id, ids array<int>, decoded string``, or with ``keep_ids=False`` the digest
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``. A null or empty text has no tokens and decodes
    to the empty text. Repeated rows and ids are encoded row by row, an empty table gives an empty one;
    other columns are not read. One narrow stage, no shuffle.
    """
    spark = docs.sparkSession
    shared.bytes_per_batch(spark)
    table = spark.sparkContext.broadcast(compile(path))

    def run(batches):
        encoder = shared.worker_state(_text_encoder if not keep_ids else Encoder, table.value)  # known words outlive a task
        for batch in batches:
            for start, end in slices(batch.column(1)):
                keys = batch.column(0).slice(start, end - start)
                found = encoder.batch(batch.column(1).slice(start, end - start).to_pylist(), not keep_ids)
                yield from pieces(keys, found) if keep_ids else [digests(keys, found)]

    def slices(texts):
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE)) + 1
        return [(a, b) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True) if a < b]

    def digests(keys, found):
        counts, first, second = [], [], []
        for entries in found:
            counts.append(sum(x[0] for x in entries))
            first.append(hashlib.sha256(" ".join([x[1] for x in entries]).encode()).hexdigest())
            second.append(hashlib.sha256(" ".join([x[2] for x in entries]).encode()).hexdigest())
        return pa.record_batch([keys, pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                               ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def pieces(keys, found):
        start, ids, decoded, held = 0, [], [], 0
        for i, entries in enumerate(found, 1):
            ids.append(np.frombuffer(b"".join([x[1] for x in entries]), np.int32))
            decoded.append(" ".join([x[2] for x in entries]))
            held += len(ids[-1])
            if held >= PIECE or i == len(keys):
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.record_batch([keys.slice(start, i - start), lists, pa.array(decoded, pa.string())],
                                      ["doc_id", "ids", "decoded"])
                start, ids, decoded, held = i, [], [], 0

    selected = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    rest = "ids array<int>, decoded string" if keep_ids else "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return selected.mapInArrow(run, f"doc_id {kind}, {rest}")


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``doc_id, decoded`` from arrays of token ids; null ids decode to the empty text."""
    labels = encoded.sparkSession.sparkContext.broadcast(pretokens.read(path).texts)

    def run(batches):
        for batch in batches:
            out = [" ".join(map(labels.value.__getitem__, ids or [])) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["doc_id", "decoded"])

    selected = encoded.select(F.col(id_column).alias("doc_id"), F.col(ids_column).alias("ids"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    return selected.mapInArrow(run, f"doc_id {kind}, decoded string")
