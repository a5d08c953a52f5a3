"""BPE encoding and decoding with a public vocabulary, merges in batched numpy rounds.

The distinct words of a batch lie in one flat array of symbols. Every round looks up all neighbouring
pairs by binary search in the sorted pair keys, finds the lowest-ranked pair of each word and merges it.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_with_id

#: Fixed values of the vocabulary format: white space of the normaliser, words of the splitter.
SPACE = r"\t-\r \x85\xa0  -     　"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+"
WORD_END = "</w>"
_CONTROL = regex.compile("[\x1c-\x1f]")
_NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge tables, special tokens and the two directions for one vocabulary file."""

    #: Words remembered between groups of texts, and words of the texts worked on together.
    CACHED_WORDS, GROUP_WORDS = 400_000, 200_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = [""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in [*ids.items(), *self.special.items()]:
            self.tokens[i] = token
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = made
        # The first merge that uses a symbol; where it comes later than the merge that makes the
        # symbol, all places of a pair can be merged in one round.
        first_use = np.full(len(self.tokens), _NO_RANK)
        ranks = np.arange(len(merges))
        np.minimum.at(first_use, left, ranks)
        np.minimum.at(first_use, right, ranks)
        self.all_at_once = first_use[made] > ranks
        symbols = byte_symbols()
        self.inside = np.array([ids[s] for s in symbols], np.int64)
        self.ending = np.array([ids[s + WORD_END] for s in symbols], np.int64)
        self.known: dict[str, tuple[str, str, int]] = {}
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self._mark = regex.compile(f"({marks})") if marks else None
        self._space = regex.compile(f"[{SPACE}]+")
        self._word = regex.compile(WORD)
        self.id_text = [str(i) for i in range(len(self.tokens))]

    def split(self, run: str) -> list[str]:
        """Words of a text in order; a special token that it spells out is a word of its own."""
        if self._mark and "<" in run and self._mark.search(run):
            found: list[str] = []
            for part in self._mark.split(run):
                found += [part] if part in self.special else self._plain(part)
            return found
        return self._plain(run)

    def _plain(self, text: str) -> list[str]:
        # White space is in no word, so making it one space would change nothing.
        text = unicodedata.normalize("NFC", text)
        # Characters are lowered one by one: no final form of sigma.
        return self._word.findall(text.replace("\u03a3", "\u03c3").lower())

    def runs(self, text: str | None) -> list[str]:
        """Stretches without white space: neither words nor special tokens nor composition cross it."""
        if not text:
            return []
        if _CONTROL.search(text):  # what only Python takes for white space
            return [r for r in self._space.split(text) if r]
        return text.split()

    def learn(self, runs: set[str]) -> None:
        """Encode new stretches together; remember ids, decoded text and number of tokens of each."""
        new = [r for r in runs if r not in self.known]
        if not new:
            return
        split = [self.split(r) for r in new]
        plain = list({w for words in split for w in words if w not in self.special})
        ids = {s: [i] for s, i in self.special.items()}
        for start in range(0, len(plain), 50_000):
            part = plain[start : start + 50_000]
            ids.update(zip(part, self.merge(part)))
        id_text, tokens = self.id_text, self.tokens
        for run, words in zip(new, split):
            own = ids[words[0]] if len(words) == 1 else [i for w in words for i in ids[w]]
            self.known[run] = (
                " ".join([id_text[i] for i in own]),
                " ".join([tokens[i] for i in own]),
                len(own),
            )

    def merge(self, words: list[str]) -> list[list[int]]:
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(d) for d in data])
        flat = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.inside[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.ending[flat[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            symbols, owner, settled = self._round(symbols, owner)
            done.append(settled)
        owners = np.concatenate([o for _, o in done])
        order = np.argsort(owners, kind="stable")
        ids = np.concatenate([s for s, _ in done])[order]
        cuts = np.searchsorted(owners[order], np.arange(1, len(words)))
        ids, cuts = ids.tolist(), [0, *cuts.tolist(), len(ids)]
        return [ids[i:j] for i, j in zip(cuts[:-1], cuts[1:])]

    def _round(self, symbols: np.ndarray, owner: np.ndarray):
        """Merge the lowest-ranked pair of every word; words without one are settled."""
        keys = (symbols[:-1] << 32) | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[at] == keys) & (owner[:-1] == owner[1:])
        rank = np.append(np.where(known, self.ranks[at], _NO_RANK), _NO_RANK)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(starts, len(owner)))
        least = np.minimum.reduceat(rank, starts)
        least_here = np.repeat(least, sizes)
        chosen = (rank == least_here) & (least_here != _NO_RANK)
        places = np.flatnonzero(chosen)
        # Leftmost first: of places that overlap take every other one, from the start of the run.
        if len(places):
            run = np.append(True, np.diff(places) != 1)
            first = places[np.flatnonzero(run)][np.cumsum(run) - 1]
            places = places[(places - first) % 2 == 0]
            once = np.append(True, owner[places][1:] != owner[places][:-1])
            places = places[once | self.all_at_once[rank[places]]]
        symbols = symbols.copy()
        symbols[places] = self.made[rank[places]]
        stay = np.ones(len(symbols), bool)
        stay[places + 1] = False
        active = least_here != _NO_RANK
        settled = (symbols[~active], owner[~active])
        return symbols[stay & active], owner[stay & active], settled

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, str, int]]:
        """For each text its ids in decimal, the decoded text, both joined by spaces, and their number."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(self.runs(text))
            size += len(group[-1])
            if size >= self.GROUP_WORDS:
                yield from self._encoded(group)
                group, size = [], 0
        yield from self._encoded(group)

    def _encoded(self, group: list[list[str]]) -> Iterator[tuple[str, str, int]]:
        if len(self.known) > self.CACHED_WORDS:
            self.known.clear()
        self.learn(set().union(*group))
        get = self.known.__getitem__
        for runs in group:
            if runs:
                ids, decoded, counts = zip(*map(get, runs))
                yield " ".join(ids), " ".join(decoded), sum(counts)
            else:
                yield "", "", 0

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, as of a vocabulary without a decoder; unknown ids are skipped."""
        return " ".join(self.tokens[i] for i in ids if 0 <= i < len(self.tokens))


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per task process; the file is part of an installed package on every machine."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encoded(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, ids, decoded`` for every row of ``docs`` (doc_id, text, ...); null is as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            ids, decoded = [], []
            for joined, text, _ in words.encode(batch["text"]):
                ids.append(np.array(joined.split(), np.int32))
                decoded.append(text)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids, "decoded": decoded})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_with_id(rows, run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs`` (doc_id, text, ...).

    Null and empty texts have no tokens and the digest of the empty string. Repeated rows and null
    ids come back as given; other columns are ignored. Texts are encoded whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = vocabulary(path)
        for batch in batches:
            rows = [
                (n, _sha256(ids), _sha256(decoded))
                for ids, decoded, n in words.encode(batch["text"])
            ]
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_with_id(
        rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
