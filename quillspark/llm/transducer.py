"""Token counts by a compiled finite-state transducer.

The tokenizer file (byte-level BPE with word ends, lower-cased text) is compiled
into a deterministic transducer over characters.  Its states hold what the next
characters can still change: the place in the word splitter, and for a word under
way the bytes that may still become part of a longer token, with the last token
and the open count at each place where such a token could begin.  Every
transition carries the number of tokens that it settles.  Two prefixes with the
same future share a state, so the machine grows with the fragments of words, not
with the words; transitions are determinised when a text first needs them.

A batch of texts is one sequence cut into chunks, which run in lockstep.  A
chunk's state map sends any entry state to its exit state and count.  White space
and text ends send every state to the start, so the map of a chunk that holds one
is a head, up to the first such symbol, followed by a constant.  The scan over the
chunk maps (composition: the later constant wins, heads without one are joined to
the head after them) gives each chunk's entry state; the heads, which lie apart
from one another, then run in lockstep as well.

A word's split into BPE tokens is fixed by its neighbouring pairs: a prefix ends
in the one token that merges to itself and stays apart from the token before it
(Berglund, Martens, van der Merwe, "Constructing a BPE Tokenization DFA", 2024).
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of one buffer, and chunks that run in lockstep.
BUFFER, LANES = 1 << 21, 4096

#: Transitions after which a worker drops its machine and starts another one, which bounds its memory.
MOST_TRANSITIONS = 1 << 20

#: Symbols that no text holds: end of a text, special token, filling that changes nothing.
END, SPECIAL, FILL = 0xD800, 0xD801, 0xD802

# Unicode's White_Space characters, and the contractions that the word pattern splits off.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000)
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def byte_letters() -> dict[str, int]:
    """Letter of a byte-level vocabulary -> byte: printable Latin-1 stands for itself, the rest follows from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(other)}}


class Bpe:
    """Byte-level BPE with word ends as a machine over the bytes of one word.

    A token is ``(bytes, ends a word)``.  A core state is ``(open, last, count)``:
    the longest end of the prefix that begins a token, and for each place in it
    the token that ends there and the open count (None and -1 where no token can
    begin any more).
    """

    def __init__(self, spec: dict):
        letters, end = byte_letters(), spec["end_of_word_suffix"]

        def token(s: str) -> tuple[bytes, bool]:
            last = s.endswith(end)
            return bytes(letters[c] for c in (s[:-len(end)] if last else s)), last
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["merges"]]
        self.rank = {(token(a), token(b)): i for i, (a, b) in enumerate(pairs)}
        vocab = {token(s) for s in spec["vocab"]}
        self.inner = {t for t, last in vocab if not last}
        self.final = {t for t, last in vocab if last}
        self.begins = {t[:i] for t, _ in vocab for i in range(len(t))}
        made = {(a + b, last): i for ((a, _), (b, last)), i in self.rank.items()}
        if any(made.get(part, -1) >= i for pair, i in self.rank.items() for part in pair):
            raise ValueError("a merge comes before the merge that makes its part")
        self.fits: dict = {}
        self.edges: dict = {}
        self.core_of: dict = {}
        self.cores: list = []
        self.pushed: dict = {}
        self.closed: dict = {}
        self.start = self._core((b"", (None,), (0,)))

    def _edges(self, token: tuple[bytes, bool]) -> tuple[list, list]:
        """Pieces at a token's left and right end while it merges, each with the
        rank that merges it into the next one (the whole token: no rank)."""
        if token not in self.edges:
            (whole, last), left, right = token, [], []
            pieces = [(whole[i:i + 1], last and i == len(whole) - 1) for i in range(len(whole))]
            none = len(self.rank)
            while len(pieces) > 1:
                rank, at = min((self.rank.get(pair, none), i) for i, pair in enumerate(zip(pieces, pieces[1:])))
                if rank == none:
                    break
                if at == 0:
                    left.append((pieces[0], rank))
                if at == len(pieces) - 2:
                    right.append((pieces[-1], rank))
                pieces[at:at + 2] = [(pieces[at][0] + pieces[at + 1][0], pieces[at + 1][1])]
            if pieces != [token]:
                left = right = None
            else:
                left.append((token, none))
                right.append((token, none))
            self.edges[token] = left, right
        return self.edges[token]

    def _fits(self, before: bytes | None, token: tuple[bytes, bool]) -> bool:
        """Whether ``token`` merges to itself and stays apart from the token ``before`` it (None: a word's start).

        Ranks grow while pieces merge, so a pair across the border is merged if it
        comes before the next merge of both pieces; of equal ranks the left one is first.
        """
        key = before, token
        fits = self.fits.get(key)
        if fits is None:
            left = self._edges(token)[0]
            right = [] if before is None else self._edges((before, False))[1]
            fits = left is not None and right is not None
            i = j = 0
            none = len(self.rank)
            while fits and i < len(right):
                a, until_a = right[i]
                b, until_b = left[j]
                rank = self.rank.get((a, b), none)
                if rank < until_a and rank <= until_b and rank < none:
                    fits = False
                elif until_a == until_b == none:
                    break
                elif until_a <= until_b:
                    i += 1
                else:
                    j += 1
            self.fits[key] = fits
        return fits

    def _core(self, core: tuple) -> int:
        if core not in self.core_of:
            self.core_of[core] = len(self.cores)
            self.cores.append(core)
        return self.core_of[core]

    def _ending(self, core: int, byte: bytes, vocab: set, last: bool) -> int:
        """Place in the open bytes where the token begins that ends with ``byte``."""
        held, tokens, counts = self.cores[core]
        text = held + byte
        for i, count in enumerate(counts):
            if count >= 0 and (end := text[i:]) in vocab and self._fits(tokens[i], (end, last)):
                return i
        raise ValueError(f"the vocabulary has no token for byte {byte!r}")

    def push(self, core: int, byte: bytes) -> tuple[int, int]:
        """Core state after a byte inside a word, and the tokens that it settles."""
        key = core, byte
        found = self.pushed.get(key)
        if found is None:
            held, tokens, counts = self.cores[core]
            text = held + byte
            at = self._ending(core, byte, self.inner, False)
            tokens, counts = [*tokens, text[at:]], [*counts, counts[at] + 1]
            first = len(text)
            for i in range(len(text) - 1, -1, -1):
                if text[i:] in self.begins:
                    first = i
                else:
                    tokens[i], counts[i] = None, -1
            settled = min(c for c in counts[first:] if c >= 0)
            left = tuple(c - settled if c >= 0 else -1 for c in counts[first:])
            found = self.pushed[key] = self._core((text[first:], tuple(tokens[first:]), left)), settled
        return found

    def close(self, core: int, byte: bytes) -> int:
        """Tokens that are settled when the word ends with ``byte``."""
        key = core, byte
        if key not in self.closed:
            self.closed[key] = self.cores[core][2][self._ending(core, byte, self.final, True)] + 1
        return self.closed[key]


class Machine:
    """Characters -> settled tokens: the word splitter with a word machine inside.

    A word's last byte waits until the next character shows whether the word ends.
    States: 0 between words; after an apostrophe that begins a token; after that
    and a letter that may continue a contraction; else ``(class, core, waiting byte)``.
    """

    def __init__(self, spec: dict):
        self.bpe = Bpe(spec["model"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.states: list = [None]
        self.state_of: dict = {None: 0}
        self.kinds = dict.fromkeys(WHITE_SPACE, "space")
        self.table = Transitions(self.step)

    def _state(self, state) -> int:
        if state not in self.state_of:
            self.state_of[state] = len(self.states)
            self.states.append(state)
        return self.state_of[state]

    def kind(self, symbol: int) -> str:
        kind = self.kinds.get(symbol)
        if kind is None:
            group = unicodedata.category(chr(symbol))[0]
            kind = self.kinds[symbol] = {"L": "letter", "N": "number"}.get(group, "other")
        return kind

    def word(self, text: str) -> int:
        """Tokens of one whole word."""
        data, core, n = text.encode(), self.bpe.start, 0
        for i in range(len(data) - 1):
            core, settled = self.bpe.push(core, data[i:i + 1])
            n += settled
        return n + self.bpe.close(core, data[-1:])

    def _grow(self, kind: str, core: int, waiting: bytes, char: str) -> tuple[int, int]:
        """A word that goes on, or begins, with ``char``."""
        data, n = waiting + char.encode(), 0
        for i in range(len(data) - 1):
            core, settled = self.bpe.push(core, data[i:i + 1])
            n += settled
        return self._state((kind, core, data[-1:])), n

    def _left(self, state) -> int:
        """Tokens still to settle when what is under way ends here."""
        if state is None:
            return 0
        if isinstance(state, str):  # an apostrophe, and a letter that begins a word of its own
            return self.word(state[0]) + (self.word(state[1:]) if state[1:] else 0)
        return self.bpe.close(*state[1:])

    def step(self, at: int, symbol: int) -> tuple[int, int]:
        """Next state and settled tokens."""
        state = self.states[at]
        if symbol == FILL:
            return at, 0
        if symbol == SPECIAL:
            return 0, self._left(state) + 1
        kind, char = self.kind(symbol), chr(symbol)
        if kind == "space":
            return 0, self._left(state)
        if kind == "number":
            return 0, self._left(state) + self.word(char)
        if isinstance(state, str):
            if state + char in CONTRACTIONS:
                return 0, self.word(state + char)
            if any(c.startswith(state + char) for c in CONTRACTIONS):
                return self._state(state + char), 0
            # No contraction: the apostrophe is of class other, a letter after it begins a word.
            so_far, n = ("other", state), 0
            if len(state) > 1:
                so_far, n = ("letter", state[1:]), self.word(state[0])
            into, settled = self._grow(so_far[0], self.bpe.start, b"", so_far[1])
            nxt, more = self.step(into, symbol)
            return nxt, n + settled + more
        if state is not None and state[0] == kind:
            return self._grow(kind, state[1], state[2], char)
        done = self._left(state)
        if char == "'":
            return self._state("'"), done
        nxt, settled = self._grow(kind, self.bpe.start, b"", char)
        return nxt, done + settled


class Transitions:
    """The determinised transitions as an open-addressing table in numpy, filled on demand."""

    def __init__(self, step, bits: int = 19):
        self.step, self.known = step, {}
        self._make(bits)

    def _make(self, bits: int) -> None:
        import numpy as np
        self.bits, self.mask = bits, (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for key, value in self.known.items():
            self._put(key, value)

    def _slot(self, key):
        import numpy as np
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _put(self, key: int, value: int) -> None:
        at = ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while self.keys[at] != -1:
            at = (at + 1) & self.mask
        self.keys[at], self.values[at] = key, value

    def value(self, key: int) -> int:
        """``next state << 20 | settled`` of one key ``state << 21 | symbol``."""
        found = self.known.get(key)
        if found is None:
            nxt, settled = self.step(key >> 21, key & 0x1FFFFF)
            found = self.known[key] = nxt << 20 | settled
            if 2 * len(self.known) > self.mask:
                self._make(self.bits + 1)
            else:
                self._put(key, found)
        return found

    def values_of(self, key):
        """``value`` of an array of keys."""
        import numpy as np
        slot = self._slot(key)
        odd = np.flatnonzero(self.keys[slot] != key)
        out = self.values[slot]
        at = slot[odd]
        while len(odd):
            held = self.keys[at]
            hit, empty = held == key[odd], held == -1
            out[odd[hit]] = self.values[at[hit]]
            if empty.any():
                new, back = np.unique(key[odd[empty]], return_inverse=True)
                bits = self.bits
                out[odd[empty]] = np.array([self.value(k) for k in new.tolist()], np.int64)[back]
                if bits != self.bits:  # the table was laid out anew
                    rest = odd[~(hit | empty)]
                    out[rest] = [self.value(k) for k in key[rest].tolist()]
                    break
            go = ~(hit | empty)
            odd, at = odd[go], (at[go] + 1) & self.mask
        return out


def run(machine: Machine, symbols, entry: int, lanes: int = LANES):
    """Settled tokens at each symbol, and the exit state, of a sequence entered in ``entry``."""
    import numpy as np
    table, n = machine.table, len(symbols)
    width = max(64, -(-n // lanes))
    rows = -(-n // width)
    grid = np.full(rows * width, FILL, np.int64)
    grid[:n] = symbols
    grid = grid.reshape(rows, width)
    blank = np.isin(grid, [*WHITE_SPACE, END])
    resets = blank | (grid == SPECIAL)
    grid[blank] = 32  # a text's end does what white space does
    first = np.where(resets.any(1), resets.argmax(1), width)  # a chunk without a reset is all head
    first[0] = -1  # its entry is known
    # Every chunk from behind its first reset, in lockstep; heads are blanked, which keeps the start state.
    steps = np.where(np.arange(width)[None, :] <= first[:, None], 32, grid).T.copy()
    settled = np.zeros((width, rows), np.int32)
    state = np.zeros(rows, np.int64)
    state[0] = entry
    for i in range(width):
        value = table.values_of(state << 21 | steps[i])
        state = value >> 20
        settled[i] = value & 0xFFFFF
    out = settled.T.reshape(-1)[:n].copy()
    # The scan: a chunk with a reset has a constant exit; the head that follows it reaches to the next reset.
    fixed = np.flatnonzero(first < width)
    at = (fixed + 1) * width
    stop = np.minimum(np.append(fixed[1:] * width + first[fixed[1:]] + 1, n), n)
    at = np.minimum(at, stop)
    state = state[fixed]
    flat, live = grid.reshape(-1), np.flatnonzero(at < stop)
    leave = state.copy()
    while len(live) > 16:
        where = at[live]
        value = table.values_of(leave[live] << 21 | flat[where])
        leave[live] = value >> 20
        out[where] = value & 0xFFFFF
        at[live] += 1
        live = live[at[live] < stop[live]]
    for k in live.tolist():
        now = int(leave[k])
        for where, symbol in enumerate(flat[at[k]:stop[k]].tolist(), int(at[k])):
            value = table.value(now << 21 | symbol)
            now = value >> 20
            out[where] = value & 0xFFFFF
        leave[k] = now
    return out, int(leave[-1])


def pieces(text: str, special: Iterable[str], size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, special tokens as one symbol.

    Parts begin with an ASCII character, which no composition joins with the text before it.
    """
    for s in special:
        text = text.replace(s, chr(SPECIAL))
    at = 0
    while len(text) - at > size:
        end = next((i for i in range(at + size, len(text)) if text[i] < "\x80"), len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def count_texts(machine: Machine, texts: Iterable[str | None], size: int = BUFFER, lanes: int = LANES) -> list[int]:
    """Tokens of each text."""
    import numpy as np
    counts: list[int] = []
    held, length, open_count, state = [], 0, 0, 0

    def flush() -> None:
        nonlocal held, length, open_count, state
        whole = unicodedata.normalize("NFC", "".join(held)).replace("Σ", "σ").lower()
        symbols = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        held, length = [], 0
        if not len(symbols):
            return
        settled, state = run(machine, symbols, state, lanes)
        total = np.cumsum(settled, dtype=np.int64)
        ends = total[symbols == END]
        if len(ends):
            counts.extend((np.diff(ends, prepend=0) + np.where(np.arange(len(ends)) == 0, open_count, 0)).tolist())
            open_count = int(total[-1] - ends[-1])
        else:
            open_count += int(total[-1])
    for text in texts:
        for part in pieces(text or "", machine.special, size):
            held.append(part)
            length += len(part)
            if length >= size:
                flush()
        held.append(chr(END))
        length += 1
    flush()
    return counts


def machine_of(path: str) -> Machine:
    """The worker's machine for a tokenizer file; a worker keeps it from task to task."""
    kept = sys.modules.setdefault("_kept_transducers", types.ModuleType("_kept_transducers")).__dict__
    machine = kept.get(path)
    if machine is None or len(machine.table.known) > MOST_TRANSITIONS:
        with open(path, encoding="utf-8") as f:
            machine = kept[path] = Machine(json.load(f))
    return machine


def count_column(text: str, path: str, size: int = BUFFER, lanes: int = LANES) -> Column:
    """Tokens of a text column as the tokenizer file at ``path`` gives them."""
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(count_texts(machine_of(path), texts, size, lanes), dtype="int64")
    return count(F.col(f"`{text}`"))


def token_counts(docs: DataFrame, path: str, limit: int, text: str = "text", n_tokens: str = "n_tokens",
                 over_limit: str = "over_limit", **settings) -> DataFrame:
    """``docs`` with the token count of each text and whether it is above ``limit``.

    ``path`` names a byte-level BPE file with word ends; begin, end and other
    special tokens are not added, their strings inside a text count as one token
    each.  Null and empty texts have no tokens; a text of any length is counted
    whole, in parts that carry the state; repeated rows count alike; an empty
    table stays empty.  Columns of ``docs`` that are called like a result are
    replaced.
    """
    bounded_batches(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (n_tokens, over_limit)]
    out = docs.select(*kept, count_column(text, path, **settings).alias(n_tokens))
    return out.withColumn(over_limit, F.col(n_tokens) > limit)
