r"""Token counts by finite-state transducers compiled from a tokenizer file.

Two deterministic machines read each text; the tokenizer library takes no part.

* Splitter, over characters: the file's pattern cuts normalised text into words.
  Its five states are: free, in letters, in other signs, and one or two letters
  left of a contraction ('s, 're).  Whether a quote may open a contraction is
  looked up ahead and makes it an input sign of its own.  Each sign maps states
  to states; these maps generate a small monoid, whose product table is compiled
  once.  Characters are read in chunks: the maps inside all chunks are composed
  side by side, the chunks' own maps are composed by the same scan, a level up,
  and so the state before each character comes from a parallel prefix scan.

* Merger, over the bytes of a word, the last one marked as such: its states hold
  what the merges can still depend on, for each start p of a token that may
  yet end later: the place of the text since p in the tokens' tree, the last
  token of the prefix up to p, and the tokens of that prefix less those of the
  prefix read so far.  A token t ends the encoding of a prefix if the merges
  leave t beside the last token before it, and just one t does.  A transition
  emits the tokens of the longer prefix less those of the shorter (which may be
  negative), so the sum along a word is its number of tokens.  Words start anew,
  hence all words of a slice step through the table together.  States and
  transitions are determinised when first met, by the merges alone; the table
  starts anew, keeping the states in use, beyond ``STATES``.

Texts are cut into pieces at white space, which frees both machines; a run
without white space is never cut.  Everything happens beside the scan; nothing
is shuffled.  Character classes are those of Python's Unicode tables.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import BASE, U, sums_by, table, text_slices

TOKENIZER = "word_bpe_49k.json"
#: States that the merger's table holds before it starts anew.
STATES = 200_000
#: Characters that are composed one after another; chunks are composed side by side.
CHUNK = 64
#: Characters of a piece, and of the pieces that are read together.
PIECE = 1 << 20
#: Words longer than this step through the table one by one.
LONG = 64
LIMIT = 2048

# The pattern and the word end of the files that this module compiles.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Unicode's white space.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

SPACE, LETTER, NUMBER, OTHER, QUOTE_ONE, QUOTE_TWO = range(6)
FREE, LETTERS, OTHERS, ONE_LEFT, TWO_LEFT = range(5)
#: State after each sign, by the state before.
MOVES = [
    (FREE, FREE, FREE, FREE, FREE),
    (LETTERS, LETTERS, LETTERS, FREE, ONE_LEFT),
    (FREE, FREE, FREE, FREE, FREE),
    (OTHERS, OTHERS, OTHERS, OTHERS, OTHERS),
    (ONE_LEFT, ONE_LEFT, OTHERS, ONE_LEFT, ONE_LEFT),
    (TWO_LEFT, TWO_LEFT, OTHERS, TWO_LEFT, TWO_LEFT),
]
#: Whether a word begins at a sign, by the state before it.
BEGINS = np.array([
    (0, 0, 0, 0, 0),
    (1, 0, 1, 0, 0),
    (1, 1, 1, 1, 1),
    (1, 1, 0, 1, 1),
    (1, 1, 0, 1, 1),
    (1, 1, 0, 1, 1),
], bool)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def monoid(moves: list[tuple]) -> tuple[list[tuple], np.ndarray]:
    """All products of some maps of states, the identity first and ``moves`` next, and their product table."""
    found = list(dict.fromkeys([tuple(range(len(moves[0]))), *moves]))
    for a in found:
        for m in moves:
            b = tuple(m[s] for s in a)
            if b not in found:
                found.append(b)
    at = {m: k for k, m in enumerate(found)}
    return found, np.array([[at[tuple(b[s] for s in a)] for b in found] for a in found], np.uint8)


def composed(maps: np.ndarray, product: np.ndarray, chunk: int) -> np.ndarray:
    """Products of all maps up to each: inside chunks side by side, over chunks by the same scan."""
    n, chunk = len(maps), max(2, chunk)
    rows = -(-n // chunk)
    grid = np.zeros(rows * chunk, np.uint8)
    grid[:n] = maps
    grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
    for k in range(1, min(chunk, n)):
        grid[k] = product[grid[k - 1], grid[k]]
    if rows > 1:
        grid[:, 1:] = product[composed(grid[-1, :-1], product, chunk), grid[:, 1:]]
    return grid.T.ravel()[:n]


class Splitter:
    """The pattern as a machine over characters."""

    def __init__(self):
        elements, self.product = monoid(MOVES)
        at = {m: k for k, m in enumerate(elements)}
        self.map_of = np.array([at[m] for m in MOVES], np.uint8)
        self.landing = np.array([m[FREE] for m in elements], np.uint8)
        kinds = {"L": LETTER, "N": NUMBER}
        self.kind = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        self.kind[SPACES] = SPACE

    def signs(self, chars: np.ndarray) -> np.ndarray:
        out = self.kind[chars]
        quote = np.flatnonzero(chars == ord("'"))
        if len(quote):
            ahead = np.concatenate([chars, np.zeros(2, chars.dtype)])
            a, b = ahead[quote + 1], ahead[quote + 2]
            out[quote[np.isin(a, [ord(c) for c in "stmd"])]] = QUOTE_ONE
            two = np.zeros(len(quote), bool)
            for pair in ("re", "ve", "ll"):
                two |= (a == ord(pair[0])) & (b == ord(pair[1]))
            out[quote[two]] = QUOTE_TWO
        return out

    def words(self, chars: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end, in characters."""
        if not len(chars):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        signs = self.signs(chars)
        after = self.landing[composed(self.map_of[signs], self.product, chunk)]
        begins = BEGINS[signs, np.concatenate([np.full(1, FREE, np.uint8), after[:-1]])]
        inside = signs != SPACE
        ends = inside.copy()
        ends[:-1] &= begins[1:] | ~inside[1:]
        return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def byte_signs() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merger:
    """The merges as a transducer over the bytes of words; symbols from 256 on are last bytes."""

    START = ((0, -1, 0),)

    def __init__(self, merges: list, most: int = STATES):
        self.most = most
        signs, ids = byte_signs(), {}
        self.spelt = []
        for end in (0, 1):
            for char, byte in sorted(signs.items(), key=lambda kv: kv[1]):
                ids[char + WORD_END * end] = len(self.spelt)
                self.spelt.append((byte + 256 * end,))
        self.merge, self.parts = {}, {}
        for rank, pair in enumerate(merges):
            a, b = (ids[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = "".join(pair.split(" ") if isinstance(pair, str) else pair)
            if whole not in ids:
                ids[whole] = len(self.spelt)
                self.spelt.append(self.spelt[a] + self.spelt[b])
            if (a, b) not in self.merge:
                self.merge[a, b] = rank, ids[whole]
                self.parts.setdefault(ids[whole], (a, b, rank))
        self.tree, self.token_at = {}, {}
        for token, symbols in enumerate(self.spelt):
            node = 0
            for x in symbols:
                node = self.tree.setdefault(node << 9 | x, len(self.tree) + 1)
            self.token_at[node] = token
        self.inner = {key >> 9 for key in self.tree}
        self.whole, self.edge, self.beside = {}, {}, {}
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = [self.START], {self.START: 0}
        self.steps, self.held = np.full(1 << 16, -1, np.int64), 0
        self.after, self.emitted = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int16)
        if len(self.beside) > 1 << 20:
            self.beside = {}

    def merged(self, tokens: list[int]) -> list[int]:
        """``tokens`` after all merges, lowest rank first, leftmost first."""
        while len(tokens) > 1:
            rank, k = min((self.merge.get(p, (len(self.merge),))[0], k) for k, p in enumerate(zip(tokens, tokens[1:])))
            if rank == len(self.merge):
                break
            tokens = [*tokens[:k], self.merge[tokens[k], tokens[k + 1]][1], *tokens[k + 2:]]
        return tokens

    def edges(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at an end of ``token`` (0 left, 1 right) as it is merged, and the ranks that end them."""
        if (token, side) not in self.edge:
            run, at, rank = [], token, len(self.merge)
            while at is not None:
                run.append((at, rank))
                at, rank = (self.parts[at][side], self.parts[at][2]) if at in self.parts else (None, 0)
            self.edge[token, side] = run
        return self.edge[token, side]

    def stands(self, last: int, token: int) -> bool:
        """Whether the merges leave ``token`` beside ``last``, or whole at a word's start (-1).

        They don't if a pair across the border merges before either of its parts
        goes into its own token; of equal ranks the leftmost is first.
        """
        if token not in self.whole:
            self.whole[token] = self.merged(list(self.spelt[token])) == [token]
        if last < 0 or not self.whole[token]:
            return self.whole[token]
        known = self.beside.get(last << 20 | token)
        if known is None:
            known = not any(
                self.merge.get((x, y), (len(self.merge),))[0] < min(gone, until + 1)
                for x, gone in self.edges(last, 1) for y, until in self.edges(token, 0))
            self.beside[last << 20 | token] = known
        return known

    def step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """The transition of ``state`` on ``symbol``: the next state and the tokens emitted."""
        live, token = [], None
        for node, last, owed in state:
            child = self.tree.get(node << 9 | symbol)
            if child is None:
                continue
            live.append((child, last, owed))
            if token is None and child in self.token_at and self.stands(last, self.token_at[child]):
                token, emitted = self.token_at[child], owed + 1
        return (*((n, t, o - emitted) for n, t, o in live if n in self.inner), (0, token, 0)), emitted

    def number(self, state: tuple) -> int:
        k = self.at.get(state)
        if k is None:
            k = self.at[state] = len(self.keys)
            self.keys.append(state)
        return k

    def places(self, steps: np.ndarray) -> np.ndarray:
        """Where the table holds each (state, symbol), or is free for it."""
        size = len(self.steps)
        place = (steps.astype(U) * U(BASE) >> U(65 - size.bit_length())).astype(np.int64)
        off = np.arange(len(steps))
        while len(off):
            held = self.steps[place[off]]
            off = off[(held != steps[off]) & (held >= 0)]
            place[off] = (place[off] + 1) & (size - 1)
        return place

    def put(self, steps: np.ndarray, after: np.ndarray, emitted: np.ndarray) -> None:
        """Enter distinct new transitions; the table is at most half full."""
        if 2 * (self.held + len(steps)) > len(self.steps):
            old = np.flatnonzero(self.steps >= 0)
            steps, after, emitted = (np.concatenate([a[old], b]) for a, b in
                                     ((self.steps, steps), (self.after, after), (self.emitted, emitted)))
            size = len(self.steps)
            while 2 * len(steps) > size:
                size *= 2
            self.steps, self.held = np.full(size, -1, np.int64), 0
            self.after, self.emitted = np.zeros(size, np.int32), np.zeros(size, np.int16)
        self.held += len(steps)
        while len(steps):
            place = self.places(steps)
            first = np.unique(place, return_index=True)[1]
            self.steps[place[first]], self.after[place[first]] = steps[first], after[first]
            self.emitted[place[first]] = emitted[first]
            rest = np.ones(len(steps), bool)
            rest[first] = False
            steps, after, emitted = steps[rest], after[rest], emitted[rest]

    def walk(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a symbol each, and the tokens emitted; transitions that are missing are determinised."""
        steps = states.astype(np.int64) << 9 | symbols
        place = self.places(steps)
        new = np.unique(steps[self.steps[place] < 0])
        if len(new):
            got = [self.step(self.keys[s >> 9], s & 511) for s in new.tolist()]
            after = [self.number(key) if s & 511 < 256 else 0 for s, (key, _) in zip(new.tolist(), got)]
            self.put(new, np.array(after, np.int32), np.array([n for _, n in got], np.int16))
            place = self.places(steps)
        return self.after[place], self.emitted[place]

    def renumbered(self, states: np.ndarray) -> np.ndarray:
        """``states`` in a table begun anew."""
        used, at = np.unique(states, return_inverse=True)
        used = [self.keys[s] for s in used]
        self.clear()
        return np.array([self.number(key) for key in used], np.int32)[at]

    def count_long(self, word: bytes) -> int:
        state, n, known = 0, 0, {}
        for byte in word[:-1]:
            got = known.get(state << 9 | byte)
            if got is None:
                if len(self.keys) > self.most:
                    state, known = int(self.renumbered(np.array([state]))[0]), {}
                after, emitted = self.walk(np.array([state]), np.array([byte]))
                got = known[state << 9 | byte] = int(after[0]), int(emitted[0])
            state, n = got[0], n + got[1]
        return n + int(self.walk(np.array([state]), np.array([256 + word[-1]]))[1][0])

    def counts(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word of ``buf``; words step together, the longest first, so that those under way are the first ones."""
        size, out = ends - starts, np.zeros(len(starts), np.int64)
        for k in np.flatnonzero(size > LONG):
            out[k] = self.count_long(buf[starts[k]:ends[k]].tobytes())
        order = np.argsort(-size, kind="stable")
        order = order[np.searchsorted(-size[order], -LONG):]
        size, first = size[order], starts[order]
        state, n = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        for k in range(int(size[0]) - 1 if len(size) else 0):
            if len(self.keys) > self.most:
                state = self.renumbered(state)
            m = int(np.searchsorted(-size, -(k + 1), "left"))
            state[:m], emitted = self.walk(state[:m], buf[first[:m] + k])
            n[:m] += emitted
        out[order] = n + self.walk(state, buf[ends[order] - 1].astype(np.int64) + 256)[1]
        return out


class Tokens:
    """Both machines of a tokenizer file, its normaliser and its special strings."""

    def __init__(self, path: str, most: int = STATES):
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        split, model = rules["pre_tokenizer"]["pretokenizers"][0], rules["model"]
        if split["pattern"].get("Regex") != PATTERN or model["end_of_word_suffix"] != WORD_END:
            raise ValueError(f"{path}: not a tokenizer of words with word ends")
        self.splitter, self.merger = Splitter(), Merger(model["merges"], most)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in rules["added_tokens"]) or r"(?!)")

    def normalised(self, text: str) -> str:
        # lower() alone would turn a last sigma into its final form.
        return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def count(self, texts: list[str], chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each text."""
        out, held, size = np.zeros(len(texts), np.int64), [], 0
        for k, text in enumerate(texts):
            for piece in pieces(text):
                if "<" in piece:
                    out[k] += len(self.special.findall(piece))
                    piece = self.special.sub(" ", piece)
                held.append((k, self.normalised(piece)))
                size += len(piece)
                if size >= PIECE:
                    self.add(held, out, chunk)
                    held, size = [], 0
        self.add(held, out, chunk)
        return out

    def add(self, held: list[tuple[int, str]], out: np.ndarray, chunk: int) -> None:
        text = "\n".join(p for _, p in held)
        buf, chars = np.frombuffer(text.encode(), np.uint8), np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts, ends = self.splitter.words(chars, chunk)
        cuts = np.cumsum([0] + [len(p) + 1 for _, p in held])
        bounds = np.searchsorted(starts, cuts)
        if len(buf) != len(chars):
            width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
            place = np.concatenate([[0], np.cumsum(width)])
            starts, ends = place[starts], place[ends]
        np.add.at(out, np.array([k for k, _ in held], np.int64), sums_by(self.merger.counts(buf, starts, ends), bounds))


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """``text`` cut at white space into pieces of about ``size`` characters."""
    lo = 0
    while len(text) - lo > size:
        cut = max(text.rfind(c, lo, lo + size) for c in " \n\t")
        if cut <= lo:
            cut = min((p for p in (text.find(c, lo + size) for c in " \n\t") if p >= 0), default=len(text))
        yield text[lo:cut]
        lo = cut
    if lo < len(text):
        yield text[lo:]


_COMPILED: dict[str, Tokens] = {}


def compiled(path: str) -> Tokens:
    if path not in _COMPILED:
        _COMPILED[path] = Tokens(path)
    return _COMPILED[path]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT,
                 chunk_bytes: int = CHUNK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty and has no tokens; a null doc_id stays null;
    repeated rows each have their row; other columns are ignored; an empty
    table gives an empty result.  ``tokenizer`` is a file of the public
    tokenizers that drops white space and marks word ends; others raise.
    Special strings inside texts count as one token each, the library's
    default.  The result doesn't depend on ``chunk_bytes``, the characters of a
    chunk.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(tokenizer_path(tokenizer))
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column(1), 2 * PIECE):
                raw = buf.tobytes()
                n = machine.count([raw[a:b].decode() for a, b in zip(off[:-1], off[1:])], chunk_bytes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(off[1:] - off[:-1]), pa.array(n),
                     pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.col("text"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"))


def op3_transducer_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
