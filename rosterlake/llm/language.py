"""Language identification by cross-parsing with suffix automata.

Per language a suffix automaton recognises every substring of a sample of labelled text. A text
is parsed greedily into longest substrings of the sample; the language whose sample needs the
fewest phrases, each weighted by the bits that name a place in the sample, describes the text
best. Letters count, everything else is one separating symbol.

The automata are dense transition tables, so many texts are parsed at once: a text is cut into
segments of fixed length, and all segments step through all automata together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import giving_back, kept, unused
from .words import LOWER, byte_runs

SEGMENT = 512  # bytes; a phrase ends where its segment ends
UNKNOWN = "und"
RUN_BYTES = 2048 * SEGMENT  # bytes parsed at once
LEAST_LETTERS = 32  # texts of fewer letters are never said to be without a language

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True  # bytes of other scripts' letters


def normalize(data: np.ndarray) -> np.ndarray:
    """Lower-cased letters; all other bytes are spaces."""
    data = LOWER[data]
    return np.where(_LETTER[data], data, np.uint8(32))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        now = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return step


class Model:
    """The automata of all languages as one table of next states, -1 where a phrase ends.

    States are stored multiplied by the number of symbols, so that state + symbol is the place of
    the next state. The last symbol fills short segments and changes nothing.
    """

    def __init__(self, samples: list[tuple[str, bytes]]) -> None:
        self.names = [name for name, _ in samples]
        texts = [normalize(np.frombuffer(text, np.uint8)) for _, text in samples]
        seen = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint8)
        self.width = len(seen) + 2  # seen symbols, an unseen one, the filler
        self.symbol = np.full(256, len(seen), np.int32)
        self.symbol[seen] = np.arange(len(seen))
        tables, roots = [], []
        for text in texts:
            steps = suffix_automaton(self.symbol[text].tolist())
            base = sum(map(len, tables))
            table = np.full((len(steps), self.width), -1, np.int32)
            for state, step in enumerate(steps):
                table[state, list(step)] = [(base + to) * self.width for to in step.values()]
            table[:, -1] = (base + np.arange(len(steps))) * self.width
            tables.append(table)
            roots.append(base * self.width)
        self.next = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int32)[:, None]
        self.bits = np.array([np.log2(len(text) + 2) for text in texts])

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each language (row) and text (column)."""
        symbols = self.symbol[normalize(raw)]
        texts = len(offsets) - 1
        parts = -(-np.diff(offsets) // SEGMENT)
        owner = np.repeat(np.arange(texts), parts)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offsets[:-1][owner] + inner * SEGMENT
        size = np.minimum(offsets[1:][owner] - begin, SEGMENT)
        order = np.argsort(-size, kind="stable")  # the longest first: the rest drops out at the end
        begin, size, owner = begin[order], size[order], owner[order]
        state = np.repeat(self.roots, len(owner), axis=1)
        count = np.zeros(state.shape, np.int32)
        live = np.searchsorted(-size, -np.arange(1, SEGMENT + 1), "right")
        for t in range(int(size[0]) if len(size) else 0):
            n = live[t]
            symbol = symbols[begin[:n] + t]
            after = self.next.take(state[:, :n] + symbol)
            ended = after < 0
            count[:, :n] += ended
            restart = self.next.take(self.roots + symbol)
            np.maximum(restart, self.roots, out=restart)
            state[:, :n] = np.where(ended, restart, after)
        return np.array([np.bincount(owner, c, texts) for c in count]).reshape(len(self.names), texts)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text the best language, its share against the second best, the letters, and the
        phrases of the best language. A long text is parsed in parts of whole segments."""
        total, letters = np.zeros((len(self.names), len(texts))), np.zeros(len(texts), np.int64)
        for row, raw, offsets in byte_runs(texts, RUN_BYTES, None):
            here = slice(row, row + len(offsets) - 1)
            total[:, here] += self.counts(raw, offsets)
            letters[here] += np.diff(np.concatenate([[0], np.cumsum(_LETTER[LOWER[raw]])])[offsets])
        weights = (total + 1) * self.bits[:, None]
        best = weights.argmin(0)
        names, phrases = [self.names[b] for b in best], total[best, np.arange(len(texts))] + 1
        if len(self.names) == 1:
            return names, np.ones(len(texts)), letters, phrases
        low = np.partition(weights, 1, axis=0)
        return names, low[1] / (low[0] + low[1]), letters, phrases


def language_samples(
    docs: DataFrame, chosen: Column, key: str, text: str, lang: str, documents: int, total: int
) -> list[tuple[str, bytes]]:
    """For each language the start of up to ``documents`` chosen texts, of ``total`` bytes in all.

    Chosen are those whose keys have the smallest hashes. All languages get samples of the same
    size as far as their texts reach; the budget is shared out among them, but each has 1 KiB.
    """
    known = docs.filter(chosen & F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}"))
    order = Window.partitionBy("lang").orderBy("hash", "key")
    ranked = known.select(F.col(lang).alias("lang"), F.col(key).alias("key"), F.xxhash64(key).alias("hash"))
    picked = ranked.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= documents)
    names = picked.select("lang", "key", "hash").distinct()
    size = max(total // max(names.select("lang").distinct().count(), 1), 1024)
    taken = known.select(F.col(lang).alias("l"), F.col(key).alias("k"), F.substring(text, 1, size).alias("text"))
    joined = taken.join(F.broadcast(names), (F.col("l") == F.col("lang")) & F.col("k").eqNullSafe(F.col("key")))
    rows = joined.dropDuplicates(["lang", "key"]).select("lang", "hash", "key", "text").orderBy("lang", "hash", "key")
    samples: dict[str, list[bytes]] = {}
    for row in rows.toLocalIterator():
        samples.setdefault(row["lang"], []).append(row["text"].encode())
    out = []
    for name, texts in sorted(samples.items()):
        share = max(size // len(texts), 1)
        got = b" ".join(x[:share] for x in texts)
        rest = b" ".join(x[share:] for x in texts)  # where some texts are short, the others give more
        out.append((name, (got + b" " + rest)[:size]))
    return out


def identify_language(
    docs: DataFrame,
    chosen: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    documents: int = 32,
    total: int = 128 << 10,
) -> DataFrame:
    """``docs`` with lang_pred (a language of the labelled rows, or ``und``) and score (0 to 1).

    Learns from rows that are ``chosen`` and have a language: a bounded sample of ``documents``
    texts per language and ``total`` bytes, which is sent to the tasks. Every text is parsed
    whole. The score is the second best weight over the sum of the two best, 0.5 for a tie and 1
    if there is one language; a tie goes to the first name in byte order. NULL texts, texts without
    a letter, and all texts if nothing could be learned are ``und`` with score 0. letters and phrases
    say how many letters (bytes of them) the text has and into how many phrases the best
    language parses it; both are 0 for ``und``. Columns with the names of the new ones are replaced.
    The sample is drawn while the plan is built.
    """
    spark = docs.sparkSession
    samples = language_samples(docs, F.lit(True) if chosen is None else chosen, key, text, lang, documents, total)
    added = ("lang_pred", "score", "letters", "phrases")
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    if not samples:
        none = (F.lit(UNKNOWN), F.lit(0.0), F.lit(0).cast("bigint"), F.lit(0.0))
        return docs.select(*others, *[c.alias(n) for n, c in zip(added, none, strict=True)])
    token = hash(tuple(samples))
    shared = spark.sparkContext.broadcast(samples)

    @F.arrow_udf("lang string, score double, letters bigint, phrases double")
    @giving_back
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = kept(("language", token), lambda: Model(shared.value))
        for array in texts:
            names, *figures = model.predict(array)
            columns = [pa.array(names, pa.string()), *map(pa.array, figures)]
            yield pa.StructArray.from_arrays(columns, ["lang", "score", "letters", "phrases"])

    letter = F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))
    name = unused("_found", docs.columns)
    found = docs.withColumn(name, predict(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return found.select(
        *others,
        F.when(letter, F.col(f"{name}.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(letter, F.col(f"{name}.score")).otherwise(0.0).alias("score"),
        F.when(letter, F.col(f"{name}.letters")).otherwise(0).alias("letters"),
        F.when(letter, F.col(f"{name}.phrases")).otherwise(0.0).alias("phrases"),
    )


def has_language(least: float = 2.0) -> Column:
    """Whether a row of ``identify_language`` is in one of the learned languages at all.

    A phrase of a text in a learned language, or in one much like it, covers 2.4 letters and
    more; in random letters, codes and other scripts it covers about as many as in a text of
    chance, 1.6 and fewer (held-out rows of the benchmark tables, and strings made for it).
    Texts of fewer than ``LEAST_LETTERS`` letters are given the benefit of the doubt.
    """
    enough = (F.col("letters") < LEAST_LETTERS) | (F.col("letters") >= least * F.col("phrases"))
    return (F.col("lang_pred") != UNKNOWN) & enough
