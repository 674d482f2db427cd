"""A class-based language model: exchange clustering, class transitions and word emissions.

The words whose share of all training tokens is at least ALPHABET_SHARE are symbols of their own, so there are
at most 1 / ALPHABET_SHARE; every other word is first seen through the symbol of its ending. Exchange clustering
puts all symbols into classes so that class bigrams explain the text best. Then every other word seen
LEAST_SEEN times gets a class of its own: that in which its occurrences, next to the classes before and after
them, are likeliest. Only rarer words stay with their endings. The probability of a token is

    P(class | class before) * P(symbol | class) * P(word | symbol),

where the last factor is 1 for a word with a class of its own, else its count among the words of that ending,
with one count set aside for words never seen. Each factor sums to 1, so the whole does.

Counts and classes are taken over all training texts, and only two tables of proven size go to the tasks: the
symbols, and the words with a share of at least COUNTED_SHARE. Rarer words get count and class by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import hashes, mixed, words_of
from shelfsense.sources.session import stored

ALPHABET_SHARE = 1e-4
COUNTED_SHARE = 1e-6
LEAST_SEEN = 5
ENDINGS = 512
ENDING_BYTES = 3
CLASSES = 64
ROUNDS = 10
_FEW = 16  # tasks per round: the bigram table is bounded by the square of the alphabet
_PRIOR = 0.01  # of a symbol in its class
_BLEND = float(CLASSES)  # counts' worth of the class frequencies in every row of transitions


@dataclass(frozen=True)
class Alphabet:
    """Hashes of the symbol words, in order; then come the endings, then the end of a text."""

    words: np.ndarray

    @property
    def size(self) -> int:
        return len(self.words) + ENDINGS + 1

    def symbols(self, words: list[bytes], hashed: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashed)
        known = at < len(self.words)
        known[known] = self.words[at[known]] == hashed[known]
        out = at.astype(np.int64)
        rare = np.flatnonzero(~known)
        if len(rare):
            tails = b"".join([words[i][-ENDING_BYTES:].rjust(ENDING_BYTES) for i in rare.tolist()])
            letters = np.frombuffer(tails, np.uint8).reshape(-1, ENDING_BYTES).astype(np.uint64)
            code = (letters * np.array([65536, 256, 1], np.uint64)).sum(1)
            out[rare] = len(self.words) + (mixed(code + np.uint64(1)) % np.uint64(ENDINGS)).astype(np.int64)
        return out


def held_out(id_col: Column, modulus: int = 7, remainder: int = 2) -> Column:
    """By the CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


# --- counting -------------------------------------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            found = [hashes(words_of(t)) for t in batch.column(0).slice(at, 2048).to_pylist()]
            word, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])


def _count_pairs(alphabet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = alphabet.value
        end = known.size - 1
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                chains = [np.array([end])]
                for text in batch.column(0).slice(at, 4096).to_pylist():
                    words = words_of(text)
                    chains += [known.symbols(words, hashes(words)), [end]]
                chain = np.concatenate(chains)  # each text runs from an end to an end
                pair, n = np.unique(chain[:-1] * known.size + chain[1:], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n, pa.int64())], names=["pair", "n"])

    return run


# --- exchange clustering --------------------------------------------------------------------------------------

def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _class_counts(pairs: DataFrame, classes: np.ndarray, size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES)
        for batch in batches:
            pair, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            total += np.bincount(classes[pair // size] * CLASSES + classes[pair % size], n, len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell].astype(np.int64))], names=["cell", "n"])

    rows = pairs.coalesce(_FEW).mapInArrow(run, "cell int, n long").toArrow()  # _FEW * CLASSES^2 rows at most
    cell, n = rows.column("cell").to_numpy(), rows.column("n").to_numpy()
    return np.bincount(cell, n, CLASSES * CLASSES).reshape(CLASSES, CLASSES) if len(cell) else np.zeros((CLASSES, CLASSES))


def best_class(counts: np.ndarray, now: int, before: np.ndarray, after: np.ndarray, twin: float) -> int:
    """The class in which a symbol adds most to the likelihood, others staying where they are.

    ``before`` and ``after`` count the classes next to the symbol, itself left out; ``twin`` counts the symbol
    next to itself. Class 0 is the end of texts alone.
    """
    rest = counts.copy()
    rest[:, now] -= before
    rest[now] -= after
    rest[now, now] -= twin
    n_before, n_after = before.sum() + twin, after.sum() + twin
    first, second = rest.sum(1), rest.sum(0)
    flat = _entropy(rest)
    column = _entropy(rest + before[:, None]) - flat
    row = _entropy(rest + after[None, :]) - flat
    own = np.diag(rest)
    gain = column.sum(0) - np.diag(column) + row.sum(1) - np.diag(row)
    gain += _entropy(own + before + after + twin) - _entropy(own)
    gain -= _entropy(first + n_after) - _entropy(first) + _entropy(second + n_before) - _entropy(second)
    gain[0] = -np.inf
    best = int(gain.argmax())
    return best if gain[best] > gain[now] + 1e-9 else now


def _neighbours(classes: np.ndarray, size: int):
    """``symbol, slot, n``: slots count classes before, classes after, and the symbol itself."""
    slots = 2 * CLASSES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a, b = pair // size, pair % size
            twin = a == b
            key = np.concatenate([
                b[~twin] * slots + classes[a[~twin]], a[~twin] * slots + CLASSES + classes[b[~twin]], a[twin] * slots + 2 * CLASSES,
            ])
            cell, place = np.unique(key, return_inverse=True)
            total = np.bincount(place, np.concatenate([n[~twin], n[~twin], n[twin]]), len(cell))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell // slots), pa.array(cell % slots), pa.array(total.astype(np.int64))], names=["symbol", "slot", "n"]
            )

    return run


def _movers(counts: np.ndarray, classes: np.ndarray):
    def run(rows: pa.Table) -> pa.Table:
        symbol, moves = rows.column("symbol").to_numpy(), []
        slot, n = rows.column("slot").to_numpy(), rows.column("n").to_numpy()
        for s in np.unique(symbol):
            mine = symbol == s
            v = np.bincount(slot[mine], n[mine], 2 * CLASSES + 1)
            now = int(classes[s])
            to = best_class(counts, now, v[:CLASSES], v[CLASSES:-1], v[-1])
            if to != now:
                moves.append((int(s), to))
        s, to = zip(*moves) if moves else ([], [])
        return pa.table({"symbol": pa.array(s, pa.int64()), "to": pa.array(to, pa.int64())})

    return run


def exchange(pairs: DataFrame, size: int, totals: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of all symbols, from their bigram counts ``(pair, n)``; ``pair`` is ``first * size + second``.

    Symbols start dealt to the classes by falling count. Each round offers a move to every other symbol, by
    turns, so that not all neighbours move at once.
    """
    order = np.argsort(-totals[:-1], kind="stable")
    classes = np.zeros(size, np.int64)
    classes[order] = 1 + np.arange(size - 1) % (CLASSES - 1)
    for k in range(rounds):
        counts = _class_counts(pairs, classes, size)
        turn = (F.pmod(F.xxhash64("symbol", F.lit(k // 2)), F.lit(2)) == k % 2) & (F.col("symbol") != size - 1)
        moves = (
            pairs.coalesce(_FEW).mapInArrow(_neighbours(classes, size), "symbol long, slot long, n long").where(turn)
            .withColumn("part", F.pmod("symbol", F.lit(64))).groupBy("part")
            .applyInArrow(_movers(counts, classes), "symbol long, to long").collect()  # a row per symbol at most
        )
        for m in moves:
            classes[m["symbol"]] = m["to"]
        if not moves and k % 2:
            break
    return classes


# --- classes of all other words ---------------------------------------------------------------------------------

def _sides(alphabet, classes: np.ndarray):
    """``word, ending, sides``: for words that are no symbols, the classes before and after, a byte each, by turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = alphabet.value
        end = known.size - 1
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                chains, names = [np.array([end])], [np.zeros(1, np.uint64)]
                for text in batch.column(0).slice(at, 4096).to_pylist():
                    words = words_of(text)
                    hashed = hashes(words)
                    chains += [known.symbols(words, hashed), [end]]
                    names += [hashed, np.zeros(1, np.uint64)]
                chain, name = np.concatenate(chains), np.concatenate(names)
                klass = classes[chain].astype(np.uint8)
                here = np.flatnonzero((chain >= len(known.words)) & (chain != end))
                here = here[np.argsort(name[here], kind="stable")]
                word, first = np.unique(name[here], return_index=True)
                cuts = pa.py_buffer(2 * np.append(first, len(here)).astype(np.int32))
                sides = pa.py_buffer(np.stack([klass[here - 1], klass[here + 1]], 1).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), pa.array(chain[here[first]], pa.int32()),
                     pa.Array.from_buffers(pa.binary(), len(word), [None, cuts, sides])],
                    names=["word", "ending", "sides"],
                )

    return run


def _evidence(counts: np.ndarray) -> np.ndarray:
    """What one occurrence after (first half) and before (second half) each class says for every class, as a logarithm."""
    transition, weight = _transitions(counts), counts.sum(0) + 1
    out = np.concatenate([transition - np.log10(weight), transition.T])
    out[:, 0] = -1e9  # the end of texts alone
    return out


def _classify(evidence: np.ndarray, least: int):
    """``word, ending, n, class`` from rows in order of words; class -1 below ``least`` occurrences."""
    width = 2 * CLASSES

    def rows(word: np.ndarray, ending: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        n = counts[:, :CLASSES].sum(1)
        klass = np.where(n >= least, (counts @ evidence).argmax(1), -1)
        return pa.RecordBatch.from_arrays(
            [pa.array(word, pa.int64()), pa.array(ending, pa.int32()), pa.array(n, pa.int64()), pa.array(klass, pa.int32())],
            names=["word", "ending", "n", "class"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the word whose rows may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            word, ending, sides = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            new = np.append(True, word[1:] != word[:-1])
            place = np.repeat(np.cumsum(new) - 1, [len(x) // 2 for x in sides]) * width
            side = np.frombuffer(b"".join(sides), np.uint8)
            cell = np.concatenate([place + side[::2], place + CLASSES + side[1::2]])
            word, ending = word[new], ending[new]
            counts = np.bincount(cell, minlength=len(word) * width).reshape(-1, width)
            if last is not None and last[0][0] == word[0]:
                counts[0] += last[2][0]
            elif last is not None:
                yield rows(*last)
            yield rows(word[:-1], ending[:-1], counts[:-1])
            last = word[-1:], ending[-1:], counts[-1:]
        if last is not None:
            yield rows(*last)

    return run


# --- the model ----------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Logarithms to base 10. ``words`` are those sent to all tasks, in order of their hashes."""

    alphabet: Alphabet
    classes: np.ndarray
    emission: np.ndarray  # P(symbol | class)
    spread: np.ndarray  # count + 1 of each symbol
    norm: np.ndarray  # what the counts in each class are divided by
    words: np.ndarray
    counts: np.ndarray
    own: np.ndarray  # the class of each word, -1 if it goes by its ending


def _transitions(counts: np.ndarray) -> np.ndarray:
    share = (counts.sum(0) + 1) / (counts.sum() + CLASSES)
    return np.log10((counts + _BLEND * share) / (counts.sum(1, keepdims=True) + _BLEND))


def _model(
    alphabet: Alphabet, classes: np.ndarray, totals: np.ndarray, weight: np.ndarray, kinds: np.ndarray,
    words: np.ndarray, counts: np.ndarray, own: np.ndarray,
) -> Model:
    """``totals`` counts the symbols without words of a class of their own; ``weight`` and ``kinds`` count those by class."""
    weight = weight + np.bincount(classes, totals, CLASSES)
    norm = np.log10(weight + _PRIOR * np.maximum(kinds + np.bincount(classes, minlength=CLASSES), 1))
    emission = np.log10(totals + _PRIOR) - norm[classes]
    return Model(alphabet, classes, emission, np.log10(totals + 1), norm, words, counts, own)


def _tag(model, n_ends: int):
    """Per text: its classes, a byte each, and what can be told without the words that are not sent along (``rare``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        end, first_ending = m.alphabet.size - 1, len(m.alphabet.words)
        never = m.emission - m.spread  # of a word not seen before, by its ending
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns: tuple[list, ...] = ([], [], [], [], [])
                rare: tuple[list, ...] = ([], [], [])
                for text in part.column(2).to_pylist():
                    words = words_of(text)
                    hashed = hashes(words)
                    symbol = m.alphabet.symbols(words, hashed)
                    klass = m.classes[symbol]
                    place = np.searchsorted(m.words, hashed)
                    sent = place < len(m.words)
                    sent[sent] = m.words[place[sent]] == hashed[sent]
                    c, own = np.zeros(len(words)), np.full(len(words), -1)
                    c[sent], own[sent] = m.counts[place[sent]], m.own[place[sent]]
                    classed, left = own >= 0, np.flatnonzero(~sent)
                    by_ending = sent & ~classed & (symbol >= first_ending)
                    klass[classed] = own[classed]
                    emitted = (
                        (np.log10(c[classed] + _PRIOR) - m.norm[own[classed]]).sum() + m.emission[symbol[symbol < first_ending]].sum()
                        + (never[symbol[by_ending]] + np.log10(c[by_ending])).sum() + m.emission[end]
                    )
                    base = np.log10(c[sent] + 1).sum() + np.log10(n_ends + 1)
                    values = (len(words) + 1, int(sent.sum()) + (n_ends > 0), float(base), float(emitted), klass.astype(np.uint8).tobytes() + b"\0")
                    for column, value in zip(columns, values):
                        column.append(value)
                    for column, value in zip(rare, (left, hashed[left].view(np.int64), never[symbol[left]])):
                        column.append(value)
                struct = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(x), t) for x, t in zip(rare, (pa.int64(), pa.int64(), pa.float64()))], names=["place", "word", "never"]
                )
                cuts = pa.array(np.cumsum([0, *map(len, rare[0])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.binary()),
                     pa.ListArray.from_arrays(cuts, struct)],
                    names=["row", "id", "n_tokens", "n_known", "base", "emitted", "classes", "rare"],
                )

    return run


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put the classes found by the join, ``place * CLASSES + class``, into the chains; the other columns stay."""
    for batch in batches:
        chains = []
        for chain, found in zip(batch.column(0).to_pylist(), batch.column(1)):
            if found.is_valid and len(found):
                klass = np.frombuffer(chain, np.uint8).copy()
                at = found.values.to_numpy()
                klass[at // CLASSES] = at % CLASSES
                chain = klass.tobytes()
            chains.append(chain)
        columns = [pa.array(chains, pa.binary()), *batch.columns[2:]]
        yield pa.RecordBatch.from_arrays(columns, names=["classes", *batch.schema.names[2:]])


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``cell, n``: class bigrams of chains, each from an end to an end."""
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in batches:
        chain = np.frombuffer(b"\0" + b"".join(batch.column(0).to_pylist()), np.uint8).astype(np.int64)
        total += np.bincount(chain[:-1] * CLASSES + chain[1:], minlength=len(total))
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])


def _walk(transition: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = []
            for chain in batch.column(0).to_pylist():
                klass = np.frombuffer(b"\0" + chain, np.uint8)
                steps.append(float(transition[klass[:-1], klass[1:]].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(steps, pa.float64())], names=[*batch.schema.names[1:], "steps"])

    return run


def _numpy(df: DataFrame, *columns: str) -> list[np.ndarray]:
    rows = df.toArrow()
    return [rows.column(c).to_numpy() for c in columns]


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
    alphabet_share: float = ALPHABET_SHARE, counted_share: float = COUNTED_SHARE, least_seen: int = LEAST_SEEN,
) -> DataFrame:
    """Train on the documents that are not held out, and score all.

    One row per document: the id, ``held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.
    Tokens are the words between ASCII white space, A to Z in lower case, and one end; null and empty texts are
    the end alone. ``base_score`` is the add-one unigram score. Rows that repeat are documents of their own. If
    no document is left to train on, all words are unknown and the scores are those of the empty model. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    training = texts.where(~held_out(F.col("id"))).select("text")
    n_ends = training.count()
    vocabulary = stored(
        training.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary"
    )
    n_words, n_kinds = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_tokens, n_kinds = n_words + n_ends, n_kinds + (n_ends > 0)
    words, n = _numpy(vocabulary.where(F.col("n") >= max(1.0, alphabet_share * n_tokens)), "word", "n")  # at most 1 / alphabet_share rows
    order = np.argsort(words.view(np.uint64))
    alphabet = Alphabet(words.view(np.uint64)[order])

    sent = spark.sparkContext.broadcast(alphabet)
    pairs = stored(training.mapInArrow(_count_pairs(sent), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "bigrams")
    second, total = _numpy(pairs.groupBy((F.col("pair") % alphabet.size).alias("s")).agg(F.sum("n").alias("n")), "s", "n")
    totals = np.bincount(second, total, alphabet.size) if len(second) else np.zeros(alphabet.size)
    classes = exchange(pairs, alphabet.size, totals, rounds)

    # all other words; none has a share of alphabet_share, so no word is hot
    evidence = _evidence(_class_counts(pairs, classes, alphabet.size))
    lexicon = stored(
        training.mapInArrow(_sides(sent, classes), "word long, ending int, sides binary")
        .repartition("word").sortWithinPartitions("word")
        .mapInArrow(_classify(evidence, least_seen), "word long, ending int, n long, class int"),
        "lexicon",
    )
    classed = lexicon.where("class >= 0")
    ending, by_ending = _numpy(classed.groupBy("ending").agg(F.sum("n").alias("n")), "ending", "n")  # a row per ending
    totals[ending] -= by_ending
    klass, by_class, kinds = _numpy(
        classed.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")), "class", "n", "kinds"
    )
    weight, many = np.zeros(CLASSES), np.zeros(CLASSES)
    weight[klass], many[klass] = by_class, kinds
    cut = max(1.0, counted_share * n_tokens)
    others, others_n, own = _numpy(lexicon.where(F.col("n") >= cut), "word", "n", "class")  # at most 1 / counted_share rows
    words, n = np.concatenate([words, others]).view(np.uint64), np.concatenate([n, others_n]).astype(np.float64)
    own = np.concatenate([np.full(len(order), -1), own])
    order = np.argsort(words)
    model = _model(alphabet, classes, totals, weight, many, words[order], n[order], own[order])

    tagged = stored(
        texts.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
            _tag(spark.sparkContext.broadcast(model), n_ends),
            f"row long, id {kind}, n_tokens long, n_known long, base double, emitted double, classes binary, "
            "rare array<struct<place: long, word: long, never: double>>",
        ),
        "tagged-texts",
    )
    # words too rare to be sent along: their counts and classes by a join, back to the texts by row
    seen = F.coalesce("n", F.lit(0))
    norms = F.array(*[F.lit(float(x)) for x in model.norm])
    emitted = F.when(F.col("class") >= 0, F.log10(seen + _PRIOR) - F.get(norms, F.col("class"))).otherwise(
        F.col("never") + F.log10(F.greatest(seen, F.lit(1)))
    )
    rare = (
        tagged.select("row", F.inline("rare")).join(lexicon.where(F.col("n") < cut).drop("ending"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10(seen + 1)).alias("rare_base"), F.sum(emitted).alias("rare_emitted"), F.count_if(seen > 0).alias("rare_known"),
            F.collect_list(F.when(F.col("class") >= 0, F.col("place") * CLASSES + F.col("class"))).alias("found"),
        )
    )
    zero = F.lit(0.0)
    whole = stored(
        tagged.drop("rare").join(rare, "row", "left")
        .select(
            "classes", "found", "id", "n_tokens",
            (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            (F.col("base") + F.coalesce("rare_base", zero)).alias("base"),
            (F.col("emitted") + F.coalesce("rare_emitted", zero)).alias("emitted"),
        )
        .mapInArrow(_corrected, f"classes binary, id {kind}, n_tokens long, n_known long, base double, emitted double"),
        "classed-texts",
    )
    steps = whole.where(~held_out(F.col("id"))).select("classes").mapInArrow(_steps, "cell long, n long")
    cell, n = _numpy(steps.groupBy("cell").agg(F.sum("n").alias("n")), "cell", "n")  # at most CLASSES^2 rows
    counts = np.bincount(cell, n, CLASSES * CLASSES) if len(cell) else np.zeros(CLASSES * CLASSES)
    transition = _transitions(counts.reshape(CLASSES, CLASSES))

    per_token = float(np.log10(n_tokens + n_kinds + 1))
    walked = whole.mapInArrow(_walk(transition), f"id {kind}, n_tokens long, n_known long, base double, emitted double, steps double")
    return walked.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("emitted") + F.col("steps")).alias("score"),
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
