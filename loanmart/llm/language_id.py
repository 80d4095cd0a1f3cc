"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

Texts are lower-cased, everything but letters becomes one space. Character n-grams of all labelled rows
are counted on Spark; the highest order keeps its counts, lower orders count the distinct characters seen
before a gram. No gram is left out. Where all counts fit in a task's memory, the models of all languages share one
sorted array of gram hashes per order, with a directory by leading bits and one column of log probabilities per
language, so a gram is looked up once for all of them. Larger counts stay tables (``Tables``): the distinct grams
of the texts get their log probabilities by joins, tasks hold those of the most frequent ones, and the others,
summed up per text, are joined. A text gets the language with the lowest cross-entropy per character. Rejection and score are
calibrated on labelled rows that were not counted.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loanmart.llm import blocks as B
from loanmart.llm.shared import utf8, written

ORDER = 4
MAX_GRAMS = 1_000_000  # counts of the highest order in all languages together that tasks hold; more stay tables
FEW = 30  # a language with fewer calibration texts has at least the spread of all languages together
PRIOR = {"spread": 0.25, "noise": 3.0}  # bits; where all languages together have too few texts
REJECT = 6.0  # standard deviations above a language's own cross-entropy
UNKNOWN = "und"
_SPACE = 32
_UNSEEN = 1 << 16  # alphabet of the uniform distribution below single characters
_FIXED = float(1 << 24)  # log probabilities from tables are whole multiples of its inverse, so sums are exact


@functools.cache
def _letters() -> np.ndarray:
    """For each code point itself if a letter, else a space; those above 16 bits folded into a private range."""
    table = np.full(0x110000, _SPACE, np.uint16)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and chr(code).isalpha():
            table[code] = code if code < 0x10000 else 0xE000 + code % 0x1800
    return table


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts, each text led by a space, and where each starts."""
    low = [" " + t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(t) for t in low])])
    kept = _letters()[codes]
    space = kept == _SPACE
    stay = np.ones(len(kept), bool)
    stay[1:] = ~(space[1:] & space[:-1])
    stay[first[:-1]] = True
    place = np.concatenate([[0], np.cumsum(stay)])
    return kept[stay].astype(np.uint64), place[first]


def grams(chars: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """The packed gram ending at every character, 0 in the place of what is before the text."""
    out = np.zeros(len(chars), np.uint64)
    row_start = np.repeat(first[:-1], np.diff(first))
    back = np.arange(len(chars)) - row_start
    for i in range(order - 1, -1, -1):
        shifted = np.zeros(len(chars), np.uint64)
        shifted[i:] = chars[: len(chars) - i]
        shifted[back < i] = 0
        out = (out << np.uint64(16)) | shifted
    return out


class HashArray:
    """Sorted 64-bit hashes with a directory of where each leading bit pattern starts."""

    def __init__(self, keys: np.ndarray):
        hashes = B.mix(keys)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.bits = max(1, len(keys).bit_length())
        ends = np.arange(1, (1 << self.bits) + 1, dtype=np.uint64)
        heads = self.hashes >> np.uint64(64 - self.bits)
        self.start = np.concatenate([[0], np.searchsorted(heads, ends)]).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in the sorted array, or -1."""
        hashes = B.mix(keys)
        head = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.start[head], self.start[head + 1]
        out = np.full(len(keys), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            hit = self.hashes[here] == hashes[left]
            out[left[hit]] = here[hit]
            at[left] += 1
            left = left[~hit & (here + 1 < end[left])]
        return out


class Model:
    """Log probabilities of characters after up to ``ORDER - 1`` others, a column for each language."""

    def __init__(self, languages: list[str], keys: np.ndarray, counts: np.ndarray):
        """``counts[i, l]``: how often packed gram ``keys[i]`` of the highest order was seen in language ``l``."""
        self.languages = languages
        levels = [(keys, counts.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            above, seen = levels[-1]
            low, place = np.unique(above & np.uint64((1 << 16 * order) - 1), return_inverse=True)
            kinds = np.zeros((len(low), len(languages)))
            np.add.at(kinds, place, seen > 0)
            levels.append((low, kinds))
        self.grams, self.values, self.contexts, self.backoffs = [], [], [], []
        below = None
        for own, seen in reversed(levels):
            once, twice = (seen == 1).sum(axis=0), (seen == 2).sum(axis=0)
            discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
            context, place = np.unique(own >> np.uint64(16), return_inverse=True)
            total, kinds = np.zeros((2, len(context), len(languages)))
            np.add.at(total, place, seen)
            np.add.at(kinds, place, seen > 0)
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            if below is None:
                lower = np.full((len(own), len(languages)), 1 / _UNSEEN)
            else:
                order = len(self.grams)
                lower = below[np.searchsorted(levels[ORDER - order][0], own & np.uint64((1 << 16 * order) - 1))]
            direct = np.where(total[place] > 0, np.maximum(seen - discount, 0) / np.maximum(total[place], 1), 0)
            below = direct + weight[place] * lower
            gram_array, context_array = HashArray(own), HashArray(context)
            self.grams.append(gram_array)
            self.values.append(np.log2(below)[gram_array.order].astype(np.float32))
            self.contexts.append(context_array)
            self.backoffs.append(np.log2(weight)[context_array.order].astype(np.float32))

    def log_probabilities(self, packed: np.ndarray) -> np.ndarray:
        """Of each packed gram's last character given the others, for each language."""
        out = np.zeros((len(packed), len(self.languages)), np.float32)
        left = np.arange(len(packed))
        for order in range(ORDER, 0, -1):
            own = packed[left] & np.uint64((1 << 16 * order) - 1) if order < 4 else packed[left]
            place = self.grams[order - 1].find(own)
            hit = place >= 0
            out[left[hit]] += self.values[order - 1][place[hit]]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            place = self.contexts[order - 1].find(own >> np.uint64(16))
            known = place >= 0
            out[left[known]] += self.backoffs[order - 1][place[known]]
        out[left] -= np.log2(_UNSEEN)
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text in each language, and its number of characters with letters."""
        chars, first = characters(texts)
        packed = grams(chars, first, ORDER)
        scored = np.diff(first) - 1  # the leading space is given
        totals = np.zeros((len(texts), len(self.languages)))
        lead = np.zeros(len(chars), bool)
        lead[first[:-1]] = True
        for at in range(0, len(chars), 1 << 18):
            part = slice(at, min(at + (1 << 18), len(chars)))
            values = self.log_probabilities(packed[part])
            values[lead[part]] = 0
            row = np.searchsorted(first, np.arange(part.start, part.stop), "right") - 1
            cut = np.flatnonzero(np.diff(row, prepend=-1))
            np.add.at(totals, row[cut], np.add.reduceat(values, cut, axis=0, dtype=np.float64))
        n_letters = np.add.reduceat(np.append(chars != _SPACE, False), first[:-1], dtype=np.int64) if len(texts) else np.zeros(0, int)
        return -totals / np.maximum(scored, 1)[:, None], np.where(n_letters > 0, scored, 0)


def _counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows."""

    def run(batches):
        for block in B.blocks(batches, "text"):
            chars, first = characters([t.decode("utf-8", "replace") for t in block.column("text").to_pylist()])
            packed = grams(chars, first, ORDER)
            lead = np.zeros(len(chars), bool)
            lead[first[:-1]] = True
            names = np.array(block.column("lang").to_pylist(), object)
            mine = np.repeat(names, np.diff(first))
            for lang in set(names):
                keys, n = np.unique(packed[(mine == lang) & ~lead], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )

    found = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _low(gram: str, order: int) -> Column:
    """The last ``order`` characters of a packed gram."""
    return F.col(gram).bitwiseAND((1 << 16 * order) - 1) if order < 4 else F.col(gram)


class Tables:
    """The model of ``Model`` as tables of any size: counts of each order, and totals of each context."""

    def __init__(self, languages: list[str], counts: DataFrame):
        """``counts``: ``lang, gram, n`` of the highest order."""
        self.languages = languages
        self.seen, self.contexts, self.discounts = {}, {}, {}
        level = counts
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                level = written(level.groupBy("lang", _low("gram", order).alias("gram")).agg(F.count("*").alias("n")))
            few = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
            few = {r["lang"]: r for r in few.collect()}  # a row for each language
            self.discounts[order] = [
                float(np.clip(few[l]["once"] / max(few[l]["once"] + 2 * few[l]["twice"], 1), 0.1, 0.95)) for l in languages
            ]
            self.seen[order] = written(level.groupBy("gram").agg(self._columns(F.col("n")).alias("seen")))
            context = level.groupBy("lang", F.shiftrightunsigned("gram", 16).alias("context"))
            context = context.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            self.contexts[order] = written(
                context.groupBy("context").agg(
                    self._columns(F.col("total")).alias("total"), self._columns(F.col("kinds")).alias("kinds")
                )
            )

    def _columns(self, value: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == l, value)), F.lit(0)) for l in self.languages])

    def resolve(self, found: DataFrame) -> DataFrame:
        """``gram, n, logs`` for each row ``gram, n``: log probabilities, a fixed-point number for each language.

        A key of these joins has at most one row for each character on either side.
        """
        needed = {ORDER: found.select("gram")}
        for order in range(ORDER - 1, 0, -1):
            needed[order] = written(needed[order + 1].select(_low("gram", order).alias("gram")).distinct())
        below = None
        for order in range(1, ORDER + 1):
            frame = needed[order].withColumn("context", F.shiftrightunsigned("gram", 16))
            frame = frame.join(self.seen[order], "gram", "left").join(self.contexts[order], "context", "left")
            if below is None:
                frame = frame.withColumn("lower", F.array(*[F.lit(1 / _UNSEEN)] * len(self.languages)))
            else:
                lower = below.select(F.col("gram").alias("end"), F.col("p").alias("lower"))
                frame = frame.withColumn("end", _low("gram", order - 1)).join(lower, "end")
            values = []
            for i, discount in enumerate(self.discounts[order]):
                seen, total, kinds, lower = (F.get(F.col(c), F.lit(i)) for c in ("seen", "total", "kinds", "lower"))
                direct = F.greatest(F.coalesce(seen, F.lit(0)) - F.lit(discount), F.lit(0.0))
                values.append(F.when(total > 0, (direct + F.lit(discount) * kinds * lower) / total).otherwise(lower))
            below = written(frame.select("gram", F.array(*values).alias("p")))
        logs = F.transform("p", lambda p: F.round(F.log2(p) * _FIXED).cast("long"))
        return found.join(below, "gram").select("gram", "n", logs.alias("logs"))


def fit(docs: DataFrame, text_col: str, lang_col: str) -> Model | Tables:
    """Counts all rows with a language. Up to ``MAX_GRAMS`` counts reach the driver, more stay tables."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), utf8(text_col).alias("text"))
    counts = written(_counts(rows))
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if counts.count() > MAX_GRAMS:
        return Tables(languages, counts)
    table = counts.toPandas()
    keys, place = np.unique(table["gram"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    seen = np.zeros((len(keys), len(languages)))
    seen[place, np.searchsorted(languages, table["lang"].to_numpy(str))] = table["n"]
    return Model(languages, keys, seen)


def entropies(docs: DataFrame, model: Model | Tables, text_col: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``_bits, _n``: cross-entropies, and characters (0: no letter)."""
    if isinstance(model, Tables):
        return _entropies_by_tables(docs, model, text_col, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_GRAMS

    def run(batches):
        for block in B.blocks(batches, text_col):
            bits, n = shared.value.cross_entropies([t or "" for t in block.column(text_col).to_pylist()])
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1, dtype=np.int32) * bits.shape[1]), pa.array(bits.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in keep), lists, pa.array(n)], [*keep, "_bits", "_n"])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in docs.select(*keep).dtypes)
    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(run, f"{schema}, _bits array<double>, _n long")


class _Cache:
    """Fixed-point log probabilities of some grams."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray):
        self.array = HashArray(keys)
        self.logs = logs[self.array.order]

    def sums(self, texts: list[str]):
        """Of each text the sums over known grams, characters with letters, and its other grams as row, gram, count."""
        chars, first = characters(texts)
        lead = np.zeros(len(chars), bool)
        lead[first[:-1]] = True
        packed = grams(chars, first, ORDER)[~lead]
        row = np.repeat(np.arange(len(texts)), np.diff(first))[~lead]
        totals, missed = np.zeros((len(texts), self.logs.shape[1]), np.int64), np.zeros(len(packed), bool)
        for at in range(0, len(packed), 1 << 18):
            part = slice(at, at + (1 << 18))
            place = self.array.find(packed[part])
            missed[part] = place < 0
            own, known = row[part][place >= 0], self.logs[place[place >= 0]]
            cut = np.flatnonzero(np.diff(own, prepend=-1))
            if len(cut):
                np.add.at(totals, own[cut], np.add.reduceat(known, cut, axis=0))
        left, n = np.unique(np.stack([row[missed].astype(np.uint64), packed[missed]]), axis=1, return_counts=True)
        n_letters = np.add.reduceat(np.append(chars != _SPACE, False), first[:-1], dtype=np.int64)
        return totals, np.where(n_letters > 0, np.diff(first) - 1, 0), left[0].astype(np.int64), left[1].view(np.int64), n


def _entropies_by_tables(docs: DataFrame, model: Tables, text_col: str, keep: list[str]) -> DataFrame:
    """Equal texts have equal sums, so what is not in the cache is summed per digest of a text."""
    texts = docs.select(F.lit("").alias("lang"), utf8(text_col).alias("text"))
    found = written(_counts(texts).select("gram", "n"))
    resolved = written(model.resolve(found))
    width = len(model.languages)
    often = resolved.orderBy(F.desc("n"), "gram").limit(max(1, MAX_GRAMS // width)).toPandas()
    logs = np.array(often["logs"].tolist(), np.int64).reshape(len(often), width)
    shared = docs.sparkSession.sparkContext.broadcast(_Cache(often["gram"].to_numpy(np.int64).view(np.uint64), logs))

    def known(batches):
        for block in B.blocks(batches, "_text"):
            totals, n, _, _, _ = shared.value.sums([t or "" for t in block.column("_text").to_pylist()])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * width), pa.array(totals.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c) for c in keep), block.column("_key"), lists, pa.array(n)], [*keep, "_key", "_sums", "_n"]
            )

    def others(batches):
        for block in B.blocks(batches, "_text"):
            _, _, row, gram, n = shared.value.sums([t or "" for t in block.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([block.column("_key").take(pa.array(row)), pa.array(gram), pa.array(n)], ["key", "gram", "n"])

    keyed = docs.select(*keep, F.col(text_col).alias("_text"), F.md5(utf8(text_col)).alias("_key"))
    schema = ", ".join(f"`{c}` {kind}" for c, kind in docs.select(*keep).dtypes)
    summed = keyed.mapInArrow(known, f"{schema}, _key string, _sums array<long>, _n long")
    rare = keyed.select("_text", "_key").mapInArrow(others, "key string, gram long, n long")
    # copies of a text have the same counts; grams of many texts are in the cache
    rare = rare.groupBy("key", "gram").agg(F.max("n").alias("times")).join(resolved.drop("n"), "gram")
    added = rare.groupBy("key").agg(F.array(*[F.sum(F.col("times") * F.col("logs")[i]) for i in range(width)]).alias("_added"))
    both = summed.join(added, F.col("_key") == F.col("key"), "left")
    bits = F.zip_with(
        "_sums", F.coalesce("_added", F.array(*[F.lit(0).cast("long")] * width)),
        lambda a, b: -(a + b) / F.lit(_FIXED) / F.greatest(F.col("_n"), F.lit(1)),
    )
    return both.select(*[F.col(f"`{c}`") for c in keep], bits.alias("_bits"), "_n")


class Calibration:
    """Scale of the score and, for each language, where its own texts lie."""

    def __init__(self, languages: list[str], found: DataFrame | None):
        """``found``: ``lang, _bits, _n`` of calibration rows. Only sums and medians of each language reach the driver.

        Texts of a language with the same length and cross-entropy count once, so copies do not narrow
        its spread. Medians are of rounded values: they need a bounded number of them, however many rows there are.
        """
        self.scale, rows = 1.0, {}
        which = F.array_position(F.array(*[F.lit(l) for l in languages] or [F.lit("")]), F.col("lang")).cast("int") - 1
        if found is not None:
            own = F.get("_bits", which)
            texts = written(
                found.where("_n > 0").select("lang", own.alias("own"), F.round(own, 6).alias("about"), "_bits", "_n")
                .dropDuplicates(["lang", "about", "_n"]).withColumn("size", F.round(F.log2("_n") * 64))
            )
            middle = texts.groupBy("lang").agg(
                F.percentile(F.round(F.col("own") * 1024) / 1024, 0.5).alias("centre"), F.percentile("size", 0.5).alias("size")
            )
            rows = {r["lang"]: r.asDict() for r in middle.collect()}  # a row for each language
        if rows:
            at = {c: F.get(F.array(*[F.lit(rows[l][c] if l in rows else 0.0) for l in languages]), which) for c in ("centre", "size")}
            off, long = F.pow(F.col("own") - at["centre"], 2), F.col("size") >= at["size"]
            sums = texts.groupBy("lang").agg(
                F.count("*").alias("n"), F.count_if(long).alias("n_long"),
                # what does not shrink with the length, and what does
                F.sum(F.when(long, off)).alias("spread"), F.sum(off * F.col("_n")).alias("noise"),
            )
            for r in sums.collect():
                rows[r["lang"]] |= r.asDict()
            self.scale = self._scale(texts)
        self._limits(languages, rows)

    def _scale(self, texts: DataFrame) -> float:
        """The one of 13 scales with the least mean logistic loss."""
        scales = [2.0**i for i in range(-6, 7)]

        def loss(s: float) -> Column:
            odds = F.transform("_bits", lambda b: F.exp(F.least(F.lit(50.0), (F.col("own") - b) * F.sqrt("_n") * F.lit(s))))
            return F.avg(F.log1p(F.aggregate(odds, F.lit(0.0), lambda a, b: a + b) - 1))

        losses = texts.agg(*[loss(s) for s in scales]).first()
        return min(zip(losses, scales))[1]

    def _limits(self, languages: list[str], rows: dict) -> None:
        """``mean, spread, noise`` of each language, finite and above 0 also where it has few texts or none."""
        self.mean, self.spread, self.noise = [], [], []
        if not rows:  # nothing to go by: a text is rejected if it is predicted no better than by the uniform distribution
            for values, value in ((self.mean, np.log2(_UNSEEN)), (self.spread, 1e-6), (self.noise, 1e-6)):
                values += [float(value)] * len(languages)
            return
        weights, centres, pooled = {"spread": "n_long", "noise": "n"}, [r["centre"] for r in rows.values()], {}
        for c, n in weights.items():
            free = sum(r[n] for r in rows.values()) - len(rows)  # a centre takes a text of each language
            pooled[c] = float(np.sqrt(sum(r[c] for r in rows.values()) / max(free, 1)))
            if free < FEW:
                pooled[c] = max(pooled[c], PRIOR[c])
        for l in languages:
            if l not in rows:  # as the hardest other language, as far off as languages differ
                self.mean.append(max(centres))
                self.spread.append(float(np.hypot(pooled["spread"], np.std(centres))))
                self.noise.append(pooled["noise"])
                continue
            own = {c: float(np.sqrt(rows[l][c] / rows[l][n])) for c, n in weights.items()}
            if rows[l]["n"] < FEW:  # and the centre is uncertain
                wider = float(np.sqrt(1 + 1 / rows[l]["n"]))
                own = {c: max(own[c], pooled[c]) * wider for c in own}
            self.mean.append(rows[l]["centre"])
            self.spread.append(own["spread"] or pooled["spread"])
            self.noise.append(own["noise"] or pooled["noise"])


def verdicts(docs: DataFrame, text_col: str, model: Model | Tables, fitted: Calibration, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with ``lang_pred, score, rejected``.

    A null text or one without letters is ``und`` with score 0 and rejected. Ties go to the first language in
    alphabetical order. A row is rejected if its cross-entropy lies further above that of its language than
    ``REJECT`` standard deviations of texts of its length; languages with few calibration texts borrow from the others.
    """
    found = entropies(docs, model, text_col, keep)
    kept = [F.col(f"`{c}`") for c in keep]
    if not model.languages:
        return found.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))

    def pick(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_best"))

    least, n = F.array_min("_bits"), F.col("_n")
    gaps = F.transform("_bits", lambda b: F.exp(F.greatest(F.lit(-700.0), (least - b) * F.sqrt(n) * F.lit(float(fitted.scale)))))
    limit = pick(fitted.mean) + REJECT * F.sqrt(F.pow(pick(fitted.spread), 2) + F.pow(pick(fitted.noise), 2) / n)
    return found.withColumn("_best", F.array_position("_bits", least).cast("int") - 1).select(
        *kept,
        F.when(n > 0, pick(model.languages)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(n > 0, 1 / F.aggregate(gaps, F.lit(0.0), lambda a, b: a + b)).otherwise(0.0).alias("score"),
        F.when(n > 0, least > limit).otherwise(True).alias("rejected"),
    )


def bucket(id_col: str, of: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of))


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[Model | Tables, Calibration]:
    """Model and calibration from rows whose id's CRC-32 is not 2 modulo 4; one in sixteen rows only calibrates."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.coalesce(bucket(id_col, 4) != 2, F.lit(True)))
    calibrating = F.coalesce(bucket(id_col, 16) == 3, F.lit(False))
    model = fit(labelled.where(~calibrating), text_col, lang_col)
    held = labelled.where(calibrating & F.col(lang_col).isin(model.languages)) if model.languages else labelled.limit(0)
    texts = held.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return model, Calibration(model.languages, entropies(texts, model, "text", ["lang"]) if model.languages else None)


def predict(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Trains on ``docs`` and predicts each row: ``id_col, held_out, lang_pred, score, rejected``.

    Null ids and null languages are predicted like others; a null id is not held out. Repeated rows are predicted
    each, an empty table gives an empty result, and other columns are not looked at.
    """
    model, fitted = train(docs, id_col, text_col, lang_col)
    held = F.coalesce(bucket(id_col, 4) == 2, F.lit(False))
    return verdicts(docs, text_col, model, fitted, [id_col]).withColumn("held_out", held)


def keep_known(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns, by models trained on ``docs``."""
    model, fitted = train(docs, id_col, text_col, lang_col)
    return verdicts(docs, text_col, model, fitted, docs.columns).where("NOT rejected").select(*[F.col(f"`{c}`") for c in docs.columns])
