"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the token sequences that the merge
list produces.  It starts as one state with an arc per base symbol; every merge
(a, b) -> c, in order, adds a gadget: the target of the a-arcs is copied without its
b-arc, the a-arcs lead to the copy, and wherever an a-arc leaves, a c-arc now leaves
too and leads to where b led.  Copies share all arcs but the one they lose, so a
gadget is stored as what it takes over, the lost arc and the step; no states or
transitions are built, an arc is derived when it is first asked for and then tabulated.
A word is encoded by running its spelling through a table of token spellings and the
automaton at once, long tokens first: every prefix of a word has exactly one accepted
path, so a position that leads nowhere is never entered again.  Decoding emits the
arc labels.

Words are cut as the tokenizer file says (NFC, white space dropped, lower case, one
pattern).  Each distinct word is encoded once per Python worker and kept.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

from pyspark.sql import DataFrame

from tablewatch.llm.common import pick, slices, worker_state

CACHE_WORDS = 300_000           # words kept per Python worker; beyond it the cache starts anew
ARCS = 2_000_000                # tabulated arcs; beyond it the table starts anew
LATIN = "\u0250"                # letters below are the same in every Unicode version
_NEVER = 1 << 60
# Fixed values of the tokenizer's format: white space of Unicode and the word pattern.
_SPACE = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                            0x205F, 0x3000]))
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + _SPACE + r"\p{L}\p{N}]+"
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")      # Python splits at these, the tokenizer does not


def byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level BPE: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class MergeAutomaton:
    """Token automaton of a merge list; tokens are numbered as in ``vocab``."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.size = 1 + max(vocab.values())
        self.label = {i: t for t, i in vocab.items()}
        self.lost: dict[int, int] = {}                       # a * size + b: step at which the target of a-arcs lost its b-arc
        self.leads: dict[int, tuple[int, int]] = {}          # c: its arcs lead to where those of b led before that step
        self.beside: dict[int, tuple[int, int]] = {}         # c: its arcs leave where those of a did up to that step
        for k, (left, right) in enumerate(merges):
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            if c in self.leads:
                raise ValueError(f"token {left + right!r} has two merges")
            self.lost[a * self.size + b] = k
            self.leads[c] = (b, k)
            self.beside[c] = (a, k)
        self.states: dict[int, list[tuple[int, int]]] = {}
        self.origins: dict[int, list[tuple[int, int]]] = {}
        self.arcs: dict[int, bool] = {}
        self.spell: list[dict] = [{}]                        # trie of spellings; "" holds the token
        for t, i in vocab.items():
            node = self.spell[0]
            for ch in self._symbols(t):
                nxt = node.get(ch)
                if nxt is None:
                    nxt = node[ch] = {}
                node = nxt
            node[""] = i

    def _symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    @staticmethod
    def _line(token: int, by: dict[int, tuple[int, int]]) -> list[tuple[int, int]]:
        """The token, what it was taken over from, and so on, each with the step until which its gadgets count."""
        out = [(token, _NEVER)]
        while token in by:
            token, step = by[token]
            out.append((token, min(step, out[-1][1])))
        return out

    def has_arc(self, last: int, token: int) -> bool:
        """Whether a ``token`` arc leaves the target of the ``last`` arcs.

        That state is the copy made by the last gadget of ``last``, of a copy of ..., of the state
        where the right part of ``last`` led when ``last`` came up; the arc came up with its own left
        part's arc.  So it is missing if any of these states lost any of these arcs in time.
        """
        key = last * self.size + token
        known = self.arcs.get(key)
        if known is None:
            states = self.states.get(last) or self.states.setdefault(last, self._line(last, self.leads))
            origins = self.origins.get(token) or self.origins.setdefault(token, self._line(token, self.beside))
            known, step_of, size = True, self.lost.get, self.size
            for x, before in states:
                for c, until in origins:
                    step = step_of(x * size + c)
                    if step is not None and step < before and step <= until:
                        known = False
            if len(self.arcs) > ARCS:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Tokens of one word given in the byte alphabet.  Symbols without a token are left out."""
        known = self.spell[0]
        symbols = [*word[:-1], word[-1] + self.suffix]
        symbols = [s for s in symbols if "" in known.get(s, ())]
        n = len(symbols)
        path, begins, dead = [], [0], set()
        choices = [self._tokens_from(symbols, 0)] if n else []
        while choices:
            last = path[-1] if path else None
            while choices[-1]:                      # the longest first
                stop, token = choices[-1].pop()
                if stop not in dead and (last is None or self.has_arc(last, token)):
                    path.append(token)
                    if stop == n:
                        return path
                    begins.append(stop)
                    choices.append(self._tokens_from(symbols, stop))
                    break
            else:                                   # a prefix has one accepted path: no other way leads on from here
                dead.add(begins.pop())
                choices.pop()
                if path:
                    path.pop()
        if n:
            raise ValueError(f"no accepted path for word {word!r}")
        return []

    def _tokens_from(self, symbols: list[str], at: int) -> list[tuple[int, int]]:
        """(end, token) of the tokens spelled from a position on, by length."""
        out, node = [], self.spell[0]
        for j in range(at, len(symbols)):
            node = node.get(symbols[j])
            if node is None:
                break
            if "" in node:
                out.append((j + 1, node[""]))
        return out


class Encoder:
    """Encodes whole texts with a tokenizer file of the word-end kind."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.automaton = MergeAutomaton(model["vocab"], [tuple(m) if not isinstance(m, str) else tuple(m.split(" "))
                                                         for m in model["merges"]], model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        self.words = regex.compile(_WORDS)
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, list[int]] = {}
        self.ids: dict[str, bytes] = {}
        self.labels: dict[str, bytes] = {}

    def normalized(self, text: str) -> str:
        # The tokenizer lower-cases letter by letter; Python's lower() looks at the neighbours of a capital sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def cut(self, text: str) -> list[str]:
        """Words in the byte alphabet; letters that younger Unicode versions may class anew are left to the library."""
        if max(text) < LATIN:
            return ["".join(map(self.letters.__getitem__, w.encode())) for w in self.words.findall(self.normalized(text))]
        return [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(text))]

    def piece(self, text: str) -> list[int]:
        out = []
        for word in self.cut(text):
            ids = self.known.get(word)
            if ids is None:
                ids = self.known[word] = self.automaton.encode(word)
            out += ids
        return out

    def keep(self, key: str, ids: list[int]) -> None:
        self.ids[key] = struct.pack(f"<{len(ids)}I", *ids)
        label = self.automaton.label
        self.labels[key] = " ".join(map(label.__getitem__, ids)).encode()

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """(ids as little-endian 32-bit words, decoded text in UTF-8)."""
        ids, labels = [], []
        at = 0
        for m in self.cut_special.finditer(text) if self.cut_special else ():
            self._plain(text[at:m.start()], ids, labels)
            ids.append(struct.pack("<I", self.special[m.group()]))
            labels.append(m.group().encode())
            at = m.end()
        self._plain(text[at:] if at else text, ids, labels)
        return b"".join(ids), b" ".join(filter(None, labels))

    def _plain(self, text: str, ids: list[bytes], labels: list[bytes]) -> None:
        parts = text.split() if not any(s in text for s in _SEPARATORS) else self._split(text)
        if len(self.ids) > CACHE_WORDS:
            self.ids.clear()
            self.labels.clear()
            self.known.clear()
        for part in set(parts).difference(self.ids):
            self.keep(part, self.piece(part))
        ids.extend(map(self.ids.__getitem__, parts))
        labels.extend(map(self.labels.__getitem__, parts))

    def _split(self, text: str) -> list[str]:
        import regex
        return [p for p in regex.split(f"[{_SPACE}]+", text) if p]


def encoder(path: str) -> Encoder:
    kept = worker_state().setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_output: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; with_output adds ids array<long> and decoded string.

    ``path`` names the tokenizer file on the executors.  A null text is an empty one
    (no tokens, both digests of the empty string).  Repeated rows and null ids keep
    their own result row; other columns are not read.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        enc = encoder(path)
        for b in slices(batches):
            done = [enc.encode(t or "") for t in b.column(1).to_pylist()]
            cols = [b.column(0), pa.array([len(i) // 4 for i, _ in done], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i, _ in done], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for _, d in done], pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_output:
                cols += [pa.array([np.frombuffer(i, "<u4").astype("i8") for i, _ in done], pa.list_(pa.int64())),
                         pa.array([d.decode() for _, d in done], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)
    src = pick(docs, id=id_col, text=text_col)
    kind = src.schema["id"].dataType.simpleString()
    more = ", ids array<long>, decoded string" if with_output else ""
    return src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
