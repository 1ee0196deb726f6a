"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

Encoding. A piece of text has exactly one token sequence in which every two neighbours would be
left alone if their bytes were merged by rank. A nondeterministic transducer guesses such
sequences: it walks the trie of tokens and may end a token wherever the pair with the token before
is stable. It is made deterministic state by state, as bytes ask for it: a state is the set of
guesses still alive, each with the tokens it has not yet agreed on with the others. What all guesses
agree on is emitted, so a token leaves after a lookahead no longer than the longest token that
could still swallow it. States are kept in a table of bounded size, which is begun anew when full; they
are packed to bytes and numbered, and a transition is one number from another, so that a table stays small.

Text is cut by the pattern that belongs to the ranks. Where a blank stands between two characters
that are no white space, no match of it can reach across, so texts are first cut there and the
stretches between, mostly words, are looked up in a bounded table of stretches already encoded. Half of
a full table is kept as the older one, and what is found there goes back: common words are not lost to rare ones.
Of the pattern `WORDS` it is known that letters after a blank are one match, and marks after them another,
so a stretch of that kind is not cut by the pattern again.

Decoding joins the bytes of tokens and passes them through an incremental UTF-8 machine, which
holds back a character until its last byte has come and puts U+FFFD for ill-formed bytes.

Defined cases: a null text is encoded as the empty one, with no ids; null ids decode to the empty
text; ids outside the vocabulary raise an error. Rows are independent; repeated rows and empty tables
need no care. A text of any length is held in one task, with its ids.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import marshal
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from plazaflow.llm.spans import left_over
from plazaflow.llm.tables import with_text

# Most transitions, stretches and pairs kept by one task; a task that does not pass its tables on has a share.
MAX_TRANSITIONS = 1_000_000
MAX_STRETCHES = 500_000
MAX_PIECES = 500_000
MAX_PAIRS = 800_000
SHARE = 0.125
LONGEST_STRETCH = 64

BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")

# A common pattern of byte-level vocabularies, and stretches of Latin letters and marks that it always cuts
# alike: the letters with the blank before them, then the marks.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")

# A transition's number holds the next state in its lower bits and what is emitted in the others.
STATE_BITS = 32
STATE = (1 << STATE_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def merged(piece: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Merging by rank, leftmost first, until so many parts are left: the definition."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > until:
        found = [ranks.get(a + b, len(ranks) + 256) for a, b in zip(parts, parts[1:])]
        i = min(range(len(found)), key=found.__getitem__)
        if parts[i] + parts[i + 1] not in ranks:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Token ids of single pieces, as int32 bytes."""

    def __init__(
        self, ranks: dict[bytes, int], max_transitions: int = MAX_TRANSITIONS, max_pairs: int = MAX_PAIRS
    ):
        self.ranks, self.max_transitions, self.max_pairs = ranks, max_transitions, max_pairs
        self.bytes_of = {v: k for k, v in ranks.items()}
        # The trie: (node, byte) to node, the token that ends at a node, nodes that go on.
        self.edges: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        # The two parts of a token's last merge, and when it is made; single bytes are there first.
        self.split: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}
        for token, rank in ranks.items():
            parts = merged(token, ranks, until=2)
            if len(token) > 1 and (len(parts) > 2 or parts[0] + parts[1] not in ranks):
                continue  # merging never makes it; only a whole piece can be it
            self.made[rank] = rank if len(token) > 1 else -1
            if len(token) > 1:
                self.split[rank] = ranks[parts[0]], ranks[parts[1]]
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.edges.get(key, 0)
                if not node:
                    node = self.edges[key] = len(self.token_at)
                    self.token_at.append(-1)
            self.token_at[node] = rank
        self.inner = {key >> 8 for key in self.edges}
        self.pairs: dict[int, bool] = {}
        self._begin()

    def _begin(self) -> None:
        # Without references within it (version 2), a packed state is the same for the same guesses.
        start = marshal.dumps(((0, -1, ()),), 2)
        self.states, self.numbers = [start], {start: 0}
        self.ends: list[bytes] = [b""]
        self.emitted: dict[bytes, int] = {b"": 0}
        self.emissions: list[bytes] = [b""]
        self.moves: dict[int, int] = {}

    def stable(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens.

        Goes back in time over the merges next to their border: of the two tokens that meet there,
        the one made last is taken apart, and what then meets must not have merged before that.
        Of merges of one rank the left one comes first.
        """
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is not None:
            return known
        if len(self.pairs) >= self.max_pairs:
            self.pairs.clear()
        ranks, bytes_of, made, split = self.ranks, self.bytes_of, self.made, self.split
        before, known = len(ranks) + 256, True
        while True:
            joint = ranks.get(bytes_of[left] + bytes_of[right])
            if joint is not None and joint < before:
                known = False
                break
            if made[left] > made[right]:
                before, left = left, split[left][1]
            elif made[right] >= 0:
                before, right = right + 1, split[right][0]
            else:
                break
        self.pairs[pair] = known
        return known

    def _move(self, state: int, byte: int) -> int:
        """The next state, and above it the number of the tokens emitted on the way to it."""
        alive, ended, stable = [], None, self.stable
        edges, inner, token_at = self.edges, self.inner, self.token_at
        for node, last, pending in marshal.loads(self.states[state]):
            node = edges.get(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                alive.append((node, last, pending))
            if ended is None:
                token = token_at[node]
                if token >= 0 and (last < 0 or stable(last, token)):
                    ended = (0, token, (*pending, token))
        if ended is None:
            raise ValueError("the ranks lack single bytes")
        agreed, tokens, final = 0, (), ended[2]
        if alive:
            alive.append(ended)
            pendings = [x[2] for x in alive]
            least = min(pendings)
            for a, b in zip(least, max(pendings)):
                if a != b:
                    break
                agreed += 1
            if agreed:
                tokens, final = least[:agreed], final[agreed:]
                alive = [(node, last, pending[agreed:]) for node, last, pending in alive]
            alive.sort()
            after = tuple(alive)
        else:
            tokens, final, after = final, (), ((0, ended[1], ()),)
        packed = marshal.dumps(after, 2)
        number = self.numbers.get(packed)
        if number is None:
            number = self.numbers[packed] = len(self.states)
            self.states.append(packed)
            self.ends.append(array("i", final).tobytes())
        said = array("i", tokens).tobytes()
        emission = self.emitted.get(said)
        if emission is None:
            emission = self.emitted[said] = len(self.emissions)
            self.emissions.append(said)
        move = self.moves[state << 8 | byte] = number | emission << STATE_BITS
        return move

    def __call__(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        if whole is not None:
            return whole.to_bytes(4, "little")
        if len(self.moves) > self.max_transitions:
            self._begin()
        out, state, move_of, emissions = b"", 0, self.moves.get, self.emissions
        for byte in piece:
            move = move_of(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            if move > STATE:
                out += emissions[move >> STATE_BITS]
                state = move & STATE
            else:
                state = move
        return out + self.ends[state]


class _Recent(dict):
    """Ids of texts, computed when first asked for. Holds at most `most`: those asked for since half of
    them were put in, and the half before."""

    def __init__(self, compute: Callable[[str], bytes], most: int):
        self.compute, self.half = compute, most // 2
        self.older: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.compute(text)
            if len(text) > LONGEST_STRETCH:
                return found
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[text] = found
        return found


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, share: float = 1.0):
        """Tables are of the largest size times `share`."""
        transitions, stretches, pieces, pairs = (
            int(most * share) for most in (MAX_TRANSITIONS, MAX_STRETCHES, MAX_PIECES, MAX_PAIRS)
        )
        self.transducer = Transducer(ranks, transitions, pairs)
        self.pattern = regex.compile(pattern)
        self.first = _Recent(self.pieces, stretches)
        self.later = _Recent(self.after_blank if pattern == WORDS else self.after_any, stretches)
        self.known = _Recent(lambda piece: self.transducer(piece.encode()), pieces)

    def pieces(self, text: str) -> bytes:
        found = self.pattern.findall(text)
        if len(found) == 1:  # its ids are kept as those of the stretch
            piece = self.known.get(found[0])
            return self.transducer(found[0].encode()) if piece is None else piece
        return b"".join(map(self.known.__getitem__, found))

    def after_any(self, stretch: str) -> bytes:
        return self.pieces(" " + stretch)

    def after_blank(self, stretch: str) -> bytes:
        plain = PLAIN.fullmatch(stretch)
        if not plain:
            return self.after_any(stretch)
        word, marks = plain.groups()
        if marks:
            return self.later[word] + self.known[marks]
        return self.transducer(b" " + word.encode())

    def encode(self, text: str | None) -> bytes:
        """Ids as int32 bytes."""
        if not text:
            return b""
        first, *later = BETWEEN_WORDS.split(text)
        return self.first[first] + b"".join(map(self.later.__getitem__, later))


class Utf8Stream:
    """Text of bytes that come in parts; a character comes out with its last byte."""

    def __init__(self):
        self.held, self.missing, self.low, self.high = b"", 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        if not self.missing:
            try:
                return data.decode()
            except UnicodeDecodeError:
                pass
        out = []
        for byte in data:
            if self.missing:
                if self.low <= byte <= self.high:
                    self.held += bytes((byte,))
                    self.missing, self.low, self.high = self.missing - 1, 0x80, 0xBF
                    if not self.missing:
                        out.append(self.held.decode())
                    continue
                out.append("�")
                self.missing, self.low, self.high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                self.held, self.missing = bytes((byte,)), 1 + (byte >= 0xE0) + (byte >= 0xF0)
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def finish(self) -> str:
        rest, self.missing = "�" * bool(self.missing), 0
        return rest


def encoder_of(shared, pattern: str, name: str) -> Encoder:
    """The task's encoder for broadcast ranks; later tasks of a worker find it filled."""
    return left_over(name, lambda: Encoder(shared.value, pattern))


def share_ranks(spark: SparkSession, path: str, pattern: str = "") -> tuple[Broadcast, str]:
    """The ranks as a broadcast, and a name that only the same ranks and pattern have."""
    ranks = read_ranks(path)
    name = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return spark.sparkContext.broadcast(ranks), name


def _text_of(ids: list[int], tokens: dict[int, bytes]) -> str:
    stream = Utf8Stream()
    parts = [
        stream.feed(b"".join(map(tokens.__getitem__, ids[i : i + 4096])))
        for i in range(0, len(ids), 4096)
    ]
    return "".join(parts) + stream.finish()


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
    keep_tables: bool = True,
) -> DataFrame:
    """All columns of `docs` and the token ids of the whole text, without special tokens. With
    `decoded_col`, also what the ids decode to, in the same task. Columns of these names are
    replaced. The rank file is read by the driver and broadcast; a vocabulary does not grow with
    the data.

    A worker keeps its tables for its next task, which saves a third of the time. Where other
    operators ran before, more workers than run at once may come to hold tables in turn; without
    `keep_tables` each task begins with empty ones, of a `SHARE` of the size, and drops them at its end."""
    docs = docs.drop(ids_col, *([decoded_col] if decoded_col else []))
    kept, (given, text) = docs.columns, with_text(docs, text_col)
    shared, name = share_ranks(docs.sparkSession, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared, pattern, name) if keep_tables else Encoder(shared.value, pattern, SHARE)
        tokens = encoder.transducer.bytes_of
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = [encoder.encode(x.as_py()) for x in texts]
            ends = np.cumsum([0, *(len(x) // 4 for x in found)])
            if ends[-1] > np.iinfo(np.int32).max:
                raise ValueError(
                    "too many ids in a batch; lower spark.sql.execution.arrow.maxRecordsPerBatch"
                )
            ids = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32))
            )
            out = batch.select(kept).append_column(ids_col, ids)
            if decoded_col:
                texts = [_text_of(np.frombuffer(x, np.int32).tolist(), tokens) for x in found]
                out = out.append_column(decoded_col, pa.array(texts, pa.string()))
            yield out
        if not keep_tables:
            del encoder, tokens
            gc.collect()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema += f", `{ids_col}` array<int>" + (f", `{decoded_col}` string" if decoded_col else "")
    return given.mapInArrow(run, schema)


def decode(
    docs: DataFrame, ranks_path: str, ids_col: str = "ids", text_col: str = "decoded"
) -> DataFrame:
    """All columns of `docs` and the text that the ids stand for."""
    docs = docs.drop(text_col)
    shared, _ = share_ranks(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {v: k for k, v in shared.value.items()}
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = [_text_of(x.as_py() or [], tokens) for x in ids]
            yield batch.append_column(text_col, pa.array(texts, pa.string()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{text_col}` string")
