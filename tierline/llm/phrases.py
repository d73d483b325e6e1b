"""Collocations: phrases whose words meet more often than their parts would by chance, by language.

Texts become runs of 64-bit word codes once, with marks where a piece ends. Then, length by length, the
candidate phrases are put into double-array tries and broadcast: numpy looks up a chunk of words at once
and takes all its positions one word further a step, and a bincount of the accepting states counts the
phrases; counts are summed over tasks. The same pass finds the candidates of the next length: a phrase
is one only if the phrases without its last and without its first word are frequent (the trie knows the
one; a bit map of hashes, which never denies a frequent phrase, the other) and if it occurs often enough
when each task's occurrences, counted up to the minimum, are summed. No candidate that may be frequent
is left out, and nothing that occurs less than the minimum enters a trie.

What is broadcast has a fixed bound: a trie takes SHARD candidates at most, of which there are at most
(words / minimum) a length; more of them make more tries, each with a pass of its own over the codes.
Word codes are verified: if two words of the corpus had the same one, another seed would be taken.

Null text is empty and a null language ``und``. Rows count as often as they repeat. Texts may be long:
they are cut anywhere, with the words that a phrase may reach beyond the cut. An empty table gives an
empty one. Ties in score are broken by count, then by phrase.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import stage

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
CHUNK = 65_000  # words looked up together; with those beyond the cut they number fewer than 2^16
SHARD = 500_000  # phrases in a trie
BITS = 25  # of the bit map's positions
MERGED = 300_000  # pairs that a task holds before it merges them
CACHED = 150_000  # words whose codes a task remembers
WINDOWS = 32  # of a trie, searched for room before cells are added
SEGMENT = 1 << 20  # bytes of a text cut into words together
BREAKS = b".,;:!?\n\v\f\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS, b"abcdefghijklmnopqrstuvwxyz" + b"\xff" * len(BREAKS))
EDGE = re.compile(rb"[ \t\xff]")
MIX = np.uint64(0x9E3779B97F4A7C15)


class _Codes(dict):
    """Codes of words, computed once; ``fresh`` lists the words not seen before."""

    def __init__(self, seed: int):
        super().__init__({b"\xff": 0})
        self.seed = seed
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word, self.seed)
        code -= (code >> 63) << 64
        self[word] = code
        self.fresh.append(word)
        return code


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text in runs; the byte 0xFF stands where a piece ends."""
    data = text.encode("utf-8", "surrogatepass").translate(LOWER)
    at = 0
    while at < len(data):
        edge = EDGE.search(data, at + SEGMENT)
        to = edge.start() if edge else len(data)
        yield data[at:to].replace(b"\xff", b" \xff ").split()
        at = to


CODED = "lang string, own int, words long, vocab binary, ids binary, fresh array<string>, codes array<long>"


def coded(docs: DataFrame, text: str, lang: str, longest: int, seed: int) -> DataFrame:
    """The words of all texts as chunks: ``ids`` (unsigned 16-bit) number ``vocab`` (64-bit codes, 0 where
    a piece ends); ``own`` positions begin phrases in the chunk, up to ``longest`` - 1 more follow.

    ``fresh`` and ``codes`` list words and their codes, each word at least once a task.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes(seed)
        held: dict[str, list[int]] = {}

        def row(name: str, run: list[int], own: int) -> pa.RecordBatch:
            vocab, ids = np.unique(np.array(run, np.int64), return_inverse=True)
            words = int(np.count_nonzero(vocab[ids[:own]]))
            fresh, known.fresh = [w.decode("utf-8", "surrogatepass") for w in known.fresh], []
            codes = [known[w.encode("utf-8", "surrogatepass")] for w in fresh]
            if len(known) > CACHED:
                known.clear()
                known[b"\xff"] = 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([own], pa.int32()),
                    pa.array([words], pa.int64()),
                    pa.array([vocab.tobytes()], pa.binary()),
                    pa.array([ids.astype("<u2").tobytes()], pa.binary()),
                    pa.array([fresh], pa.list_(pa.string())),
                    pa.array([codes], pa.list_(pa.int64())),
                ],
                names=[part.split()[0] for part in CODED.split(", ")],
            )

        def full(name: str) -> Iterator[pa.RecordBatch]:
            run, at = held[name], 0
            while len(run) - at >= CHUNK + longest - 1:
                yield row(name, run[at : at + CHUNK + longest - 1], CHUNK)
                at += CHUNK
            if at:
                held[name] = run[at:]

        for batch in batches:
            for name, body in zip(batch.column(0), batch.column(1)):  # one text at a time becomes Python's
                name = name.as_py()
                held.setdefault(name, [])
                for found in words_of(body.as_py()):
                    held[name] += [known[w] for w in found]
                    yield from full(name)
                held[name].append(0)
                if len(held) > 64 or sum(map(len, held.values())) > 16 * CHUNK:
                    for other in list(held):
                        yield from full(other)
                        rest = held.pop(other)
                        if rest:
                            yield row(other, rest, len(rest))
        for name in list(held):
            yield from full(name)
            if held[name]:
                yield row(name, held[name], len(held[name]))

    whole = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return whole.mapInArrow(cut, CODED)


class Trie:
    """A double-array trie of phrases of one length, each a path of word codes below its language.

    A state is a cell; its child by word w is the cell ``base[state] + w`` if that cell's ``check`` is
    the state. State 0 is dead; word number ``len(words)`` is no word.
    """

    def __init__(self, langs: list[str], lang: np.ndarray, paths: np.ndarray):
        self.langs = {name: i + 1 for i, name in enumerate(langs)}  # the roots' cells
        self.phrases = len(paths)
        self.words, flat = np.unique(paths, return_inverse=True)
        steps = flat.reshape(paths.shape)
        floor = len(langs) + 1 + len(self.words)
        self.base = np.zeros(floor + 1, np.int64)
        self.check = np.full(floor + 1, -1, np.int32)
        self.cursor, self.end, self.floor = floor, floor, floor
        state = lang.astype(np.int64) + 1
        for depth in range(paths.shape[1]):
            state = self._children(state, steps[:, depth])
        cells = self.end + len(self.words) + 1
        self._room(cells)
        self.base, self.check = self.base[:cells], self.check[:cells]
        self.accept = np.full(cells, -1, np.int32)
        self.accept[state] = np.arange(self.phrases)

    def _room(self, cells: int) -> None:
        if cells > len(self.check):
            more = max(cells, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _children(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places the children (parent, word) and returns the cell of each."""
        width = len(self.words) + 1
        pairs, back = np.unique(parent * width + word, return_inverse=True)
        above, by = pairs // width, pairs % width
        starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(above) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(above)))
        for at in starts[counts > 1][np.argsort(-counts[counts > 1], kind="stable")]:
            n = counts[np.searchsorted(starts, at)]
            self._place(int(above[at]), by[at : at + n])
        single = starts[counts == 1]
        if len(single):
            self._room(self.end + len(single) + 1)
            free = np.flatnonzero(self.check[self.floor : self.end + len(single)] < 0)[: len(single)] + self.floor
            self.base[above[single]] = free - by[single]
            self.check[free] = above[single]
            self.end = max(self.end, int(free[-1]) + 1)
        return (self.base[above] + by)[back]

    def _place(self, parent: int, words: np.ndarray) -> None:
        """Finds room for the children of one state: in one of the windows from the cursor on, else at the end."""
        base = self.end - int(words[0])
        tried = max(1, min(1024, (1 << 18) // len(words)))
        self._room(int(self.end + words[-1]) + tried + 1)
        for _ in range(WINDOWS):
            if self.cursor >= self.end:
                self.cursor = self.floor
            to = min(self.cursor + tried, self.end)
            bases = np.flatnonzero(self.check[self.cursor : to] < 0) + self.cursor - int(words[0])
            fits = np.flatnonzero((self.check[bases[:, None] + words[None, :]] < 0).all(axis=1))
            if len(fits):
                base = int(bases[fits[0]])
                break
            self.cursor = to
        self.base[parent] = base
        self.check[base + words] = parent
        self.end = max(self.end, base + int(words[-1]) + 1)

    def steps(self, vocab: np.ndarray) -> np.ndarray:
        """The word number of each code."""
        at = np.minimum(np.searchsorted(self.words, vocab), max(0, len(self.words) - 1))
        known = self.words[at] == vocab if len(self.words) else np.zeros(len(vocab), bool)
        return np.where(known, at, len(self.words))

    def accepted(self, lang: str, steps: np.ndarray, own: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, phrases): where among the first ``own`` a phrase begins, and which."""
        position = np.arange(min(own, max(0, len(steps) - length + 1)))
        state = np.full(len(position), self.langs.get(lang, 0), np.int64)
        for depth in range(length):
            cell = self.base[state] + steps[position + depth]
            alive = np.flatnonzero((self.check[cell] == state) & (state > 0))
            position, state = position[alive], cell[alive]
        return position, self.accept[state]


def hashes(codes: list[np.ndarray]) -> np.ndarray:
    """Positions in the bit map of phrases, given word by word."""
    found = np.zeros(len(codes[0]), np.uint64)
    for code in codes:
        found = (found ^ code.view(np.uint64)) * MIX
        found ^= found >> np.uint64(29)
    return (found * MIX) >> np.uint64(64 - BITS)


def _merged(keys: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    phrase, following, n = (np.concatenate(x) for x in zip(*keys))
    if not len(phrase):
        return phrase, following, n
    order = np.lexsort((following, phrase))
    phrase, following, n = phrase[order], following[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (phrase[1:] != phrase[:-1]) | (following[1:] != following[:-1])]))
    return phrase[first], following[first], np.add.reduceat(n, first)


COUNTED = "phrase long, following long, n long"


def _rows(block: pa.RecordBatch) -> Iterator[list]:
    """The rows of a batch, one at a time: (lang, own, vocab, ids)."""
    for values in zip(*(block.column(c) for c in ("lang", "own", "vocab", "ids"))):
        yield [v.as_py() for v in values]


def _pass(chunks: DataFrame, trie, bits, ids, length: int, least: int, further: bool) -> DataFrame:
    """What one trie counts: (phrase, null, occurrences), and, if ``further``, (phrase, following word,
    occurrences up to ``least`` of a task) of what may be frequent with that word added."""

    def batch(phrase: np.ndarray, following: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
        after = pa.nulls(len(phrase), pa.int64()) if following is None else pa.array(following)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids.value[phrase]), after, pa.array(n.astype(np.int64))], names=["phrase", "following", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, table = trie.value, bits.value
        counts = np.zeros(tree.phrases, np.int64)
        held, size = [], 0
        for block in batches:
            for lang, own, vocab, chunk in _rows(block):
                codes = np.frombuffer(vocab, np.int64)
                local = np.frombuffer(chunk, "<u2").astype(np.int64)
                position, phrase = tree.accepted(lang, tree.steps(codes)[local], own, length)
                counts += np.bincount(phrase, minlength=tree.phrases)
                if not further:
                    continue
                inner = position + length < len(local)
                position, phrase = position[inner], phrase[inner]
                after = local[position + length]
                suffix = hashes([codes[local[position + i]] for i in range(1, length + 1)])
                inner = (codes[after] != 0) & (table[suffix >> np.uint64(3)] >> (suffix & np.uint64(7)).astype(np.uint8) & 1 == 1)
                pairs, n = np.unique(phrase[inner].astype(np.int64) * len(codes) + after[inner], return_counts=True)
                held.append((pairs // len(codes), codes[pairs % len(codes)], n))
                size += len(pairs)
                if size > MERGED:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > MERGED // 2:
                        yield batch(held[0][0], held[0][1], np.minimum(held[0][2], least))
                        held, size = [], 0
        if size:
            phrase, following, n = _merged(held)
            yield batch(phrase, following, np.minimum(n, least))
        some = np.flatnonzero(counts)
        yield batch(some, None, counts[some])

    return chunks.select("lang", "own", "vocab", "ids").mapInArrow(count, COUNTED)


def _word_counts(chunks: DataFrame) -> DataFrame:
    """(lang, code, n) of each word, summed in a task before it moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                _, codes, n = _merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(n)], names=["lang", "code", "n"]
                )

        for block in batches:
            for lang, own, vocab, chunk in _rows(block):
                codes = np.frombuffer(vocab, np.int64)
                n = np.bincount(np.frombuffer(chunk, "<u2")[:own], minlength=len(codes))
                some = np.flatnonzero((n > 0) & (codes != 0))
                held.setdefault(lang, []).append((np.zeros(len(some), np.int64), codes[some], n[some]))
                size += len(some)
                if size > MERGED:
                    held = {name: [_merged(parts)] for name, parts in held.items()}
                    size = sum(len(parts[0][0]) for parts in held.values())
                    if size > MERGED // 2:
                        yield from flush()
                        held, size = {}, 0
        yield from flush()

    counts = chunks.select("lang", "own", "vocab", "ids").mapInArrow(count, "lang string, code long, n long")
    return counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _collected(candidates: DataFrame, shard: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(languages, language number, paths, ids) of one shard's candidates."""
    table = candidates.filter(F.col("shard") == shard).select("lang", "path", "id").toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    paths = table.column("path").combine_chunks().flatten().to_numpy().astype(np.int64)
    return names.dictionary.to_pylist(), names.indices.to_numpy(), paths.reshape(table.num_rows, len(paths) // max(1, table.num_rows)), table.column("id").to_numpy()


def _counted(chunks: DataFrame, candidates: DataFrame, shards: int, length: int, least: int, further: bool) -> DataFrame:
    """What the passes of all shards find ``least`` times or more, stored: (phrase, following, f)."""
    context = chunks.sparkSession.sparkContext
    bits = np.zeros(1 << (BITS - 3), np.uint8)
    for shard in range(shards):
        _, _, paths, _ = _collected(candidates, shard)
        if len(paths):
            at = hashes([np.ascontiguousarray(paths[:, i]) for i in range(length)])
            np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    sent = context.broadcast(bits)
    stored = []
    for shard in range(shards):
        langs, lang, paths, ids = _collected(candidates, shard)
        if not len(paths):
            continue
        trie, numbers = context.broadcast(Trie(langs, lang, paths)), context.broadcast(ids)
        counts = _pass(chunks, trie, sent, numbers, length, least, further)
        sums = counts.groupBy("phrase", "following").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
        stored.append(stage(sums, "counted"))
        trie.unpersist()
    out = stored[0]
    for more in stored[1:]:
        out = out.unionByName(more)
    return out


def _numbered(candidates: DataFrame) -> tuple[DataFrame, int]:
    """Candidates (lang, path) stored with an ``id`` and their ``shard``, and how many shards there are."""
    stored = stage(candidates.select("lang", "path", F.monotonically_increasing_id().alias("id")), "candidates")
    shards = -(-stored.count() // SHARD)
    return stored.withColumn("shard", F.pmod(F.xxhash64("lang", "path"), F.lit(max(1, shards)))), shards


def frequent(chunks: DataFrame, least: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """(lang, path, f) of all phrases of up to ``longest`` words that occur ``least`` times or more."""
    found = chunks.filter(F.lit(False)).select("lang", F.array("words").alias("path"), F.col("words").alias("f"))
    candidates = _word_counts(chunks).filter(F.col("n") >= least).select("lang", F.array("code").alias("path"))
    for length in range(1, longest + 1):
        candidates, shards = _numbered(candidates)
        if not shards:
            break
        counted = _counted(chunks, candidates, shards, length, least, further=length < longest)
        named = candidates.select(F.col("id").alias("phrase"), "lang", "path")
        sums = stage(counted.join(named, "phrase"), "frequent")
        found = found.unionByName(sums.filter("following is null").select("lang", "path", "f"))
        candidates = sums.filter("following is not null").select("lang", F.concat("path", F.array("following")).alias("path"))
    return found


def _scores(found: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, path, a, l, r, n, score) of the phrases of two words and more, at their lowest cut."""
    cuts = found.filter(F.size("path") > 1).withColumnRenamed("f", "a")
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("path") - 1)))
    cuts = cuts.withColumn("first", F.slice("path", F.lit(1), F.col("k"))).withColumn(
        "rest", F.slice("path", F.col("k") + 1, F.size("path") - F.col("k"))
    )
    firsts = found.select("lang", F.col("path").alias("first"), F.col("f").alias("l"))
    rests = found.select("lang", F.col("path").alias("rest"), F.col("f").alias("r"))
    met = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    exact = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(19,0)) * r)").cast("bigint")
    lowest = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("low")
    return met.groupBy("lang", "path", "a", "n").agg(lowest).select("lang", "path", "a", "low.l", "low.r", "n", "low.score")


def _covered(found: DataFrame, percent: int) -> DataFrame:
    """(lang, path) of the phrases that lie in a longer one with at least ``percent`` of their count."""
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("path") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.size("path") - m + 1), lambda at: F.slice("path", at, m)),
        )
    )
    inner = found.filter(F.size("path") > 2).select("lang", F.explode(parts).alias("path"), F.col("f").alias("longer"))
    most = inner.groupBy("lang", "path").agg(F.max("longer").alias("longer"))
    return most.join(found, ["lang", "path"]).filter(100 * F.col("longer") >= percent * F.col("f")).select("lang", "path")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT, longest: int = LONGEST,
    percent: int = 100, top: int | None = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases by score; all of them if ``top`` is None.

    ``a``, ``l`` and ``r`` count the phrase and its parts at the cut of the lowest score, ``n`` all words
    of the language. Phrases inside a longer one with ``percent`` of their count are left out.
    """
    seed = 42
    while True:
        chunks = stage(coded(docs, text, lang, longest, seed), "coded")
        pairs = chunks.select(F.explode(F.arrays_zip("codes", "fresh")).alias("p")).select("p.codes", "p.fresh")
        spelled = pairs.groupBy("codes").agg(F.min("fresh").alias("word"), F.max("fresh").alias("other"))
        if not spelled.filter("word <> other or codes = 0").limit(1).count():
            break
        seed += 1
    found = stage(frequent(chunks, least, longest), "phrases")
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    scored = _scores(found, totals).join(_covered(found, percent), ["lang", "path"], "left_anti")
    spelling = spelled.select(F.col("codes").alias("code"), "word")
    parts = scored.select("lang", "path", F.posexplode("path").alias("at", "code")).join(spelling, "code")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    named = scored.join(parts.groupBy("lang", "path").agg(joined.alias("phrase")), ["lang", "path"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = MIN_COUNT, longest: int = LONGEST, percent: int = 100, top: int = TOP) -> str:
    """DuckDB SQL for the collocations of ``documents``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), totals AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, words[i:i + m - 1] AS path FROM (
    SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM pieces, range(1, {longest + 1}) AS lengths(m)
  )
), found AS (
  SELECT lang, path, array_to_string(path, ' ') AS phrase, count(*) AS f FROM grams GROUP BY lang, path HAVING count(*) >= {least}
), cut AS (
  SELECT lang, path, phrase, f AS a, unnest(range(1, len(path))) AS k FROM found WHERE len(path) > 1
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, k,
    CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut c JOIN found x ON x.lang = c.lang AND x.path = c.path[1:k] JOIN found y ON y.lang = c.lang AND y.path = c.path[k + 1:]
    JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank FROM lowest w
  WHERE NOT EXISTS (
    SELECT 1 FROM found b WHERE b.lang = w.lang AND len(b.phrase) > len(w.phrase)
      AND contains(' ' || b.phrase || ' ', ' ' || w.phrase || ' ') AND 100 * b.f >= {percent} * w.a
  )
) WHERE rank <= {top}
"""
