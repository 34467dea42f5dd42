"""N-gram Jaccard join by set relations, and the groups of its links.

Equal sets are one class with a representative. A class lists its rarest shingles (any sharing pair of classes
above the similarity shares one of them), and sets that meet in a list are compared there, in the task that holds
the list, by what they carry with them: the parities of their shingles in 512 buckets. Two sets differ in at least as
many shingles as their parities do, so this skips pairs and loses none; the pairs left are decided on full sets.

Relations between sets save most of the work. A list is led by its most typical set. What is as close to the leader as a
link needs answers for itself through the leader and is not compared with others. For the rest, answers follow from
the leader's: sets are held in the order of their distance to it, and a set looks only at the stretch of the list whose
distances are near enough to its own, skipping the positions before and behind. Sets that are known to be
connected carry one label and are not compared. A round emits a bounded number of pairs per set, not all, and a list
goes on to the next round with the sets that still have somebody to ask.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.llm.words import MIX, joined, word_codes
from evenkeel.plans.staging import Tables, look_up, pin, stage
from evenkeel.session import small_batches, small_broadcasts

SHINGLE = 3
LEAST = 90  # links have an overlap of at least so many hundredths of the union
PARITIES = 512
BLOCK = 4096  # sets of a list that are compared in one place; longer lists are cut
MOST_ASKED = 64  # sets that one set asks about in a round
AT_ONCE = 1 << 18  # pairs whose distances are laid out at a time
TEXT_BYTES = 2 << 20  # of text whose shingles are laid out at a time
BITS = np.uint64((1 << 48) - 1)


def _residue(least: int) -> int:
    """One shingle in so many is listed first, in the order of its frequency: a quarter more than a prefix takes."""
    return max(1, 80 // (100 - least)) if least < 100 else 100


def _pack(keys: np.ndarray) -> bytes:
    return (keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (keys >> np.uint64(32)).astype("<u2").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    return np.frombuffer(blob, "<u4", n).astype(np.uint64) | np.frombuffer(blob, "<u2", n, 4 * n).astype(
        np.uint64) << np.uint64(32)


def _set(word: np.ndarray, grams: np.ndarray, shingle: int) -> np.ndarray:
    """The sorted shingle hashes of one text, from the hashes of its words and of its full shingles."""
    if len(word) >= shingle:
        return np.unique(grams[:len(word) - shingle + 1] & BITS)
    one = np.array([len(word)], np.uint64)  # fewer words are one shingle, unlike any longer one
    for w in word:
        one = joined(one, np.array([w]))
    return one[:len(word)] & BITS


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some megabytes of text; what a batch took is given back before the next."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch["text"].fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(size // TEXT_BYTES)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield batch.slice(a, b - a)
                pa.default_memory_pool().release_unused()


def _sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    bounds, codes, words = word_codes(column)
    grams = word = words[codes]
    for k in range(1, shingle):
        grams = joined(grams[:-1], word[k:])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield _set(word[a:b], grams[a:b], shingle)


def _print(keys: np.ndarray) -> tuple[int, int]:
    """Two sums over the set that tell it from others."""
    mixed = joined(keys, keys >> np.uint64(7))
    return (int(mixed.sum(dtype=np.uint64).view(np.int64)),
            int(joined(mixed, mixed).sum(dtype=np.uint64).view(np.int64)))


def _parities(keys: np.ndarray) -> bytes:
    """For each bucket of hashes, whether an odd number of the set's fall into it."""
    with np.errstate(over="ignore"):
        bucket = ((keys * MIX) >> np.uint64(55)).astype(np.int64)
    return np.packbits(np.bincount(bucket, minlength=PARITIES) & 1).tobytes()


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """``doc_id, n`` (size of the set), ``a, b`` (its fingerprint), ``prefix, early, parity, listed`` per document.

    ``prefix`` is how many shingles, in any order common to all sets, a set must list to meet every set that
    it links with. ``listed`` are the ``early`` ones, with a hash divisible by the residue, whose order is refined
    by frequency, and, if these are too few, others by hash.
    """
    residue = np.uint64(_residue(least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            rows, parity, listed = [], [], []
            for keys in _sets(batch["text"], shingle):
                n = len(keys)
                prefix = n - -(-n * least // 100) + 1 if n else 0
                early = keys[keys % residue == 0]
                rows.append((n, *_print(keys), prefix, len(early)))
                parity.append(_parities(keys))
                late = keys[keys % residue != 0][:prefix - len(early)] if prefix > len(early) else keys[:0]
                listed.append(np.concatenate([early, late]).astype(np.int64))
            numbers = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *map(pa.array, numbers), pa.array(parity, pa.binary()), pa.array(listed, pa.list_(pa.int64()))],
                ["doc_id", "n", "a", "b", "prefix", "early", "parity", "listed"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n bigint, a bigint, b bigint, prefix bigint, early bigint, parity binary, listed array<bigint>")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``row, shingles`` of the wanted classes (``row, doc_id, n, a, b``), made again from the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            keep, blobs = [], []
            asked = zip(*[batch[c].to_pylist() for c in "nab"], strict=True)
            for i, (keys, (n, a, b)) in enumerate(zip(_sets(batch["text"], shingle), asked, strict=True)):
                if (len(keys), *_print(keys)) == (n, a, b):  # another row may have the same doc_id
                    keep.append(i)
                    blobs.append(_pack(keys))
            yield pa.RecordBatch.from_arrays(
                [batch["row"].take(pa.array(keep, pa.int64())), pa.array(blobs, pa.binary())], ["row", "shingles"])

    return look_up(docs.select("doc_id", "text"), pin(wanted, "wanted"), ["doc_id"]).mapInArrow(
        run, "row bigint, shingles binary")


def _postings(classes: DataFrame, least: int) -> DataFrame:
    """``token, doc, shallow, strange``: each class at the shared shingles of its prefix, the rarest first.

    Linked sets meet at their first common shingle, where not both can be deeper in their order than a set may
    miss in one of equal size; so a list only needs to compare its shallow sets with all. ``strange`` is the share of a
    class's early shingles that no other class has, in thousandths: the set that copies were made from has few.
    """
    # Most shingles are met once: they are dropped where they are counted, and no others are moved twice.
    tokens = classes.select("row", F.explode("listed").alias("token"))
    shared = tokens.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("df > 1")
    late = F.col("token") % _residue(least) != 0
    by_class = shared.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(~late, F.struct("df", "token")))).alias("t"),
        F.collect_list(F.when(late, F.col("token"))).alias("rest")).join(
        classes.select("row", "n", "prefix", "early"), "row")
    # Early shingles of this class alone come first; they take up places of the prefix and meet nothing.
    alone = F.col("early") - F.size("t")
    listed = F.transform(F.slice("t", F.lit(1), F.greatest(F.lit(0), F.col("prefix") - alone).cast("int")),
                         lambda x, i: F.struct(x["token"].alias("token"), (
                             alone + i <= F.floor(F.col("n") * (100 - least) / (100 + least))).alias("shallow")))
    rest = F.transform("rest", lambda token: F.struct(token.alias("token"), F.lit(True).alias("shallow")))
    strange = F.floor(1000 * alone / F.greatest(F.col("early"), F.lit(1))).cast("int").alias("strange")
    return by_class.select(F.explode(F.concat(listed, rest)).alias("p"), F.col("row").alias("doc"), strange).select(
        "p.token", "doc", "p.shallow", "strange")


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``one, other, shared``: the exact overlap of each pair of classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held = None
        for batch in batches:
            shared = []
            for p, x, y in zip(batch["other"].to_pylist(), batch["of_other"], batch["of_one"], strict=True):
                if p != last:
                    last, held = p, _unpack(x.as_py())
                own = _unpack(y.as_py())
                at = np.minimum(np.searchsorted(held, own), len(held) - 1)
                shared.append(int((held[at] == own).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch["one"], batch["other"], pa.array(shared, pa.int64())], ["one", "other", "shared"])

    one = sets.select(F.col("row").alias("one"), F.col("shingles").alias("of_one"))
    other = sets.select(F.col("row").alias("other"), F.col("shingles").alias("of_other"))
    met = pairs.join(one, "one").join(other, "other").select("one", "other", "of_one", "of_other")
    return met.mapInArrow(run, "one bigint, other bigint, shared bigint").groupBy("one", "other").agg(
        F.max("shared").alias("shared"))


class _Sets:
    """Sets of one or more lists, row by row: what a comparison needs of them."""

    COLUMNS = ("place", "token", "doc", "n", "label", "strange", "shallow", "asks", "asked", "whole")

    def __init__(self, batch: pa.RecordBatch):
        for c in self.COLUMNS:
            setattr(self, c, batch[c].to_numpy(zero_copy_only=False))
        self.bits = np.frombuffer(b"".join(batch["parity"].to_pylist()), np.uint64).reshape(-1, PARITIES // 64)
        self.refuted = batch["refuted"].to_pylist()

    def allowed(self, i, j, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether sets i and j may be compared at all, and in how many shingles they may differ."""
        size = self.n[i] + self.n[j]
        need = -(-least * size // (100 + least))
        met = (self.label[i] != self.label[j]) & (self.shallow[i] | self.shallow[j])
        return met & (need <= np.minimum(self.n[i], self.n[j])), size - 2 * need

    def distance(self, i, j) -> np.ndarray:
        out = None
        for word in range(self.bits.shape[1]):
            d = np.bitwise_count(self.bits[i, word] ^ self.bits[j, word])
            out = d.astype(np.uint16) if out is None else out + d
        return out

    def pairs(self, i: np.ndarray, j: np.ndarray, least: int) -> np.ndarray:
        """Which of the pairs (i, j) may link."""
        allowed, most = self.allowed(i, j, least)
        near = allowed & (self.distance(i, j) <= most)
        for k in np.flatnonzero(near).tolist():
            if self.refuted[i[k]] and self.doc[j[k]] in self.refuted[i[k]]:
                near[k] = False
        return near


def _ask(sets: _Sets, rows: np.ndarray, least: int, each: int) -> tuple[list, np.ndarray]:
    """Pairs to be decided of one list or block, and the rows that go on to the next round.

    The leader's pairs come first. Whoever is neither near it nor connected with it looks for the ``each`` nearest sets of
    another label among those whose distance to the leader allows a link. A row that finds nobody, and that nobody finds,
    is done with the list: labels only grow together, so it will not find anybody later.
    """
    leader = rows[np.lexsort((sets.doc[rows], sets.strange[rows]))[0]]
    near = sets.pairs(np.full(len(rows), leader), rows, least)
    out = [(leader, y) for y in rows[near].tolist()]
    outside = rows[~near & (sets.label[rows] != sets.label[leader]) & sets.asks[rows]]
    found = np.zeros(len(rows), bool)
    if len(outside):
        away = sets.distance(np.full(len(rows), leader), rows).astype(np.int64)
        order = np.argsort(away, kind="stable")
        line, stretch = rows[order], away[order]
        at = dict(zip(rows.tolist(), range(len(rows))))
        own = away[[at[z] for z in outside.tolist()]]
        turn = np.argsort(own, kind="stable")
        outside, own = outside[turn], own[turn]
        # The most in which a set of this size and one that it links with can differ.
        reach = (100 - least) * (sets.n[outside] + sets.n[outside] * 100 // least + 1) // (100 + least) + 1
        step = max(1, AT_ONCE // len(rows))
        for a in range(0, len(outside), step):
            z = outside[a:a + step]
            low = np.searchsorted(stretch, (own[a:a + step] - reach[a:a + step]).min())
            high = np.searchsorted(stretch, (own[a:a + step] + reach[a:a + step]).max(), side="right")
            y = line[low:high][sets.asked[line[low:high]]]
            if not len(y):
                continue
            allowed, most = sets.allowed(z[:, None], y[None, :], least)
            apart = sets.distance(z[:, None], y[None, :]).astype(np.int64)
            may = allowed & (apart <= most)
            for k, row in enumerate(z.tolist()):
                if sets.refuted[row]:
                    may[k] &= ~np.isin(sets.doc[y], sets.refuted[row])
            hit = may.any(axis=1)
            nearest = np.argsort(np.where(may, apart, PARITIES + 1), axis=1, kind="stable")[:, :each]
            asked = np.take_along_axis(may, nearest, axis=1)
            out += zip(np.broadcast_to(z[:, None], asked.shape)[asked].tolist(), y[nearest[asked]].tolist())
            found[[at[r] for r in z[hit].tolist()]] = True
            found[[at[r] for r in y[may.any(axis=0)].tolist()]] = True
    if near.any():  # whoever stays at home has not been compared with those that the leader may yet lose
        found |= near | (sets.label[rows] == sets.label[leader])
    return out, rows[found]


def _questions(rows: DataFrame, least: int, each: int) -> DataFrame:
    """``token, doc, one, other``: pairs to be decided, and, with ``one`` null, the rows of a list that go on."""
    def answer(sets: _Sets, cuts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(cuts)
        two = cuts[:-1][sizes == 2]
        hit = two[sets.pairs(two, two + 1, least)] if len(two) else two
        first, second, rest = hit, hit + 1, []  # a list of two is settled by its one pair
        for k in np.flatnonzero(sizes > 2).tolist():
            group = np.arange(cuts[k], cuts[k + 1])
            found, on = _ask(sets, group, least, each)
            if found:
                one, other = np.array(found).T
                first, second = np.append(first, one), np.append(second, other)
                if sets.whole[group[0]]:
                    rest.append(on)
        rest = np.concatenate(rest) if rest else np.zeros(0, np.int64)
        a, b = sets.doc[first], sets.doc[second]
        none = pa.nulls(len(rest), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(sets.token[first]), pa.array(sets.token[rest])]),
             pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(sets.doc[rest])]),
             pa.concat_arrays([pa.array(np.minimum(a, b)), none]), pa.concat_arrays([pa.array(np.maximum(a, b)), none])],
            ["token", "doc", "one", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the list that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            place = whole["place"].to_numpy()
            begins = np.flatnonzero(place[1:] != place[:-1]) + 1
            last = int(begins[-1]) if len(begins) else 0
            held = whole.slice(last)
            if last:
                yield answer(_Sets(whole.slice(0, last)), np.concatenate([[0], begins]))
        if held is not None:
            yield answer(_Sets(held), np.array([0, held.num_rows]))

    return rows.repartition("place").sortWithinPartitions("place", "doc").mapInArrow(
        run, "token bigint, doc bigint, one bigint, other bigint")


def _in_blocks(lists: DataFrame, across: bool) -> DataFrame:
    """``place``: where each row of a list takes part in a comparison, with the part that it takes there.

    A list of up to ``BLOCK`` sets is one place. Longer ones are cut by a hash: at first blocks are compared within
    themselves, and when they have nothing left to ask, each with each, one place per pair of blocks.
    """
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    cut = lists.join(sizes, "token").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1) if across else F.array("own")
    met = cut.withColumn("with", F.explode(others))
    # Rows ask in the places of their own block, and are asked in those of all; (i, j) and (j, i) are one place.
    low, high = F.least("own", "with"), F.greatest("own", "with")
    return met.select(
        F.xxhash64("token", low, high).alias("place"), "token", "doc", "shallow", "strange", F.lit(True).alias("asks"),
        F.lit(True).alias("asked"), ((F.col("blocks") == 1) | F.lit(across)).alias("whole"))


def class_labels(lists: DataFrame, known: DataFrame, docs: DataFrame, shingle: int, least: int) -> DataFrame:
    """``doc, label`` of classes that meet others: all classes of a group have the smallest row among them as label.

    ``lists`` are the postings of different sets, ``known`` has ``row, doc_id, n, a, b, parity`` of each of these.
    """
    spark = lists.sparkSession
    keep = Tables(spark).put  # the tables of a round are removed when the next has replaced them
    labels = keep(known.select(F.col("row").alias("doc"), F.col("row").alias("label")), "labels")
    sets = refuted = None
    across, each = False, 1
    while True:
        facts = known.select(F.col("row").alias("doc"), "n", "parity").join(labels, "doc")
        no = spark.createDataFrame([], "doc bigint, refuted array<bigint>") if refuted is None else refuted.groupBy(
            "doc").agg(F.collect_list("other").alias("refuted"))
        rows = _in_blocks(lists, across).join(facts, "doc").join(no, "doc", "left")
        asked = keep(_questions(rows, least, each), "asked")
        each = min(4 * each, MOST_ASKED)  # what is left by now has many near misses
        pairs = keep(asked.filter("one is not null").select("one", "other").distinct(), "pairs")
        if pairs.isEmpty():
            long = lists.groupBy("token").count().filter(F.col("count") > BLOCK)
            if across or long.isEmpty():
                break
            across = True
            continue
        wanted = pairs.select(F.explode(F.array("one", "other")).alias("row")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("row"), "row", "left_anti")
        new = stage(_full_sets(docs, known.join(wanted, "row").select("row", "doc_id", "n", "a", "b"), shingle), "sets")
        sets = new if sets is None else sets.unionByName(new)
        size = [known.select(F.col("row").alias(c), F.col("n").alias(f"n_{c}")) for c in ("one", "other")]
        answers = keep(_overlaps(pairs, sets).join(size[0], "one").join(size[1], "other").withColumn(
            "linked", (100 + least) * F.col("shared") >= least * (F.col("n_one") + F.col("n_other"))), "answers")
        wrong = answers.filter(~F.col("linked"))
        both = stage(wrong.select(F.col("one").alias("doc"), "other").union(
            wrong.select(F.col("other").alias("doc"), F.col("one").alias("other"))), "refuted")
        refuted = both if refuted is None else refuted.union(both)
        named = [labels.select(F.col("doc").alias(c), F.col("label").alias(u)) for c, u in (("one", "u"), ("other", "v"))]
        grown = components(answers.filter("linked").join(named[0], "one").join(named[1], "other").select("u", "v"))
        labels = keep(labels.join(grown.withColumnRenamed("u", "label"), "label", "left").select(
            "doc", F.coalesce("component", "label").alias("label")), "labels")
        on = asked.filter("one is null").select("token", "doc").distinct()
        going = lists.join(on, ["token", "doc"], "left_semi")
        if not across:  # long lists go on whole until their blocks have been compared with each other
            long = lists.groupBy("token").count().filter(F.col("count") > BLOCK).select("token")
            going = going.join(long, "token", "left_anti").unionByName(lists.join(long, "token", "left_semi"))
        lists = keep(going, "lists")
    return labels


def link_groups(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    A null text, or one without words, has the empty set, links with nothing and is its own component. Rows
    that repeat a ``doc_id`` with different texts are separate sets. A row with a null ``doc_id`` takes no
    part and has a null component. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession), small_broadcasts(docs.sparkSession):
        return _link_groups(docs, shingle, least)


def _link_groups(docs: DataFrame, shingle: int, least: int) -> DataFrame:
    tables = Tables(docs.sparkSession)
    found = tables.put(shingle_sets(docs, shingle, least).withColumn("row", F.monotonically_increasing_id()), "found")
    sets = stage(found.select("row", "doc_id", "n", "a", "b"), "sets")
    classes = stage(sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("n", "a", "b").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("least")), "classes")
    kinds = found.join(classes.select("row"), "row")
    lists = stage(_postings(kinds, least), "postings")
    met = stage(kinds.join(lists.select(F.col("doc").alias("row")).distinct(), "row", "left_semi").select(
        "row", "doc_id", "n", "a", "b", "parity"), "met")
    tables.drop("found")
    labels = class_labels(lists, met, docs, shingle, least).select(
        F.col("doc").alias("row"), F.col("label").alias("component"))
    named = stage(classes.join(labels, "row", "left").withColumn("component", F.coalesce("component", "row")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(least.hint("merge"), "component").select("n", "a", "b", "component_id")
    whole = sets.select("doc_id", "n", "a", "b").join(known.hint("merge"), ["n", "a", "b"], "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, shingle: int = 5, least: int = 80) -> DataFrame:
    """Exactly one row of each group of linked rows, in its own columns.

    Rows are linked by their texts, whatever their ids: the one with the smallest ``doc_id`` stays, a null id
    comes after all others, and of equal ids the first row stays. Texts without words link with nothing and stay.
    """
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    rows = stage(docs.select(*[F.col(c).alias(n) for c, n in names.items()]).withColumn(
        "row", F.monotonically_increasing_id()), "rows")
    groups = link_groups(rows.select(F.col("row").alias("doc_id"), F.col(names["text"]).alias("text")), shingle, least)
    own = F.col(names["doc_id"])
    first = F.min(F.struct(own.isNull().alias("late"), own.alias("id"), "row")).alias("first")
    chosen = groups.select(F.col("doc_id").alias("row"), "component_id").join(
        rows.select("row", own).hint("merge"), "row").groupBy("component_id").agg(first).select(F.col("first.row").alias("row"))
    return rows.join(chosen.hint("merge"), "row", "left_semi").select(*[F.col(n).alias(c) for c, n in names.items()])
