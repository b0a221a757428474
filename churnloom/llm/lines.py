"""Line dedup with a log-template tree of fixed depth.

1. A line becomes words; a word with a digit in it is a variable, ``<*>``. Its leaf in the tree is
   (number of words, first ``DEPTH`` words). Words are compared by 16-bit codes, lines by 64-bit
   hashes of their words, so no text is shuffled.
2. Equal lines are merged (before the shuffle, too), then the distinct lines of a group follow each other
   in one task, which holds the templates of one group at a time. Each line joins the template that
   shares the most words, if that is ``SIMILAR`` of them at least, and turns the words that differ
   into variables; else it begins a template. Templates are found by runs of words of which one at least must agree.
3. A leaf is one group, unless it has more than ``GROUP`` distinct lines (or a ten-thousandth of all, so that the list of large
   leaves is bounded). Lines of a large leaf are dealt evenly to groups first; the templates of all its groups then meet again,
   as if they were lines: in one group once they are few enough, until then by the words of one of ``BANDS`` bands of places after the
   other (band groups that are too large are dealt evenly, too). What is still too much for one group meets in full: templates that
   share enough words agree in one run of words at least, so all that agree in a run are compared, in blocks if they are many. Each
   template meets the older one that it shares the most words with as soon as that one joins none itself. This goes on until no two
   templates of the leaf share ``SIMILAR`` of their words. Joining is greedy: near the threshold a line of a large leaf may
   join another template than it would in one group.
4. A template is recurring if its lines stand in ``MIN_DOCS`` documents or more (counted exactly).
   All its lines are dropped; the others keep their order. Joins on lines and templates are salted by document and line.

Lines of fewer than ``MIN_WORDS`` words, blank ones included, are never dropped. Null texts stay
null and have no lines. Rows that repeat an id count as one document and are cleaned alike; rows
with a null id are not counted and stay as they are. Lines join in the order of their hashes, so ties (to the older template) do
not depend on rows or tasks. Very long lines and texts are whole; empty tables give empty results. Other columns of ``docs``
stay, but for given columns ``n_lines`` and ``n_dropped``, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.llm.store import fresh, only, stored

DEPTH = 3
SIMILAR = 0.7
MIN_DOCS = 5
MIN_WORDS = 4
#: distinct lines from which on a leaf is dealt to several groups
GROUP = 8192
BANDS = 4
SALTS = 16
#: templates from which on a group looks them up by runs of words
INDEXED = 32
#: words of a line from which on templates are not met by runs of words
WIDE = 256
#: words that are compared at once when the templates of a run of words meet
CELLS = 2**24
ANY = "<*>"
_ANY_CODE = 0


def _plain(text: Column) -> Column:
    """A whole text with one space for white space inside its lines; most texts have nothing to replace."""
    return F.when(text.rlike("[\\t\\x0B\\f\\r]|  "), F.regexp_replace(text, "[ \\t\\x0B\\f\\r]+", " ")).otherwise(text)


def _variables(plain: Column) -> Column:
    words = F.transform(F.split(plain, " "), lambda w: F.when(w.rlike("[0-9]"), ANY).otherwise(w))
    return F.when(plain.rlike("[0-9]"), F.array_join(words, " ")).otherwise(plain)


def masked(text: Column) -> Column:
    """The lines of a text: words with single spaces between them, words with a digit as variables."""
    trimmed = F.transform(F.split(_plain(text), "\n"), lambda line: F.trim(line))
    # most texts have no digit, so nothing to mask
    return F.when(text.rlike("[0-9]"), F.transform(trimmed, _variables)).otherwise(trimmed)


class Leaf:
    """The templates of one group: word codes, and the first line of each."""

    def __init__(self, words: int, similar: float):
        self.codes = np.empty((4, words), np.int16)
        self.names: list[int] = []
        self.alone: list[bool] = []
        self.least = similar * words
        self.places: dict[tuple[int, bytes], list[int]] | None = None

    def _runs(self) -> list[tuple[int, int]]:
        """Runs of words of which one agrees where a line may differ in ``apart`` words after the leading ones."""
        words = self.codes.shape[1]
        apart = words - int(np.ceil(self.least))
        at = np.linspace(min(DEPTH, words), words, apart + 2).astype(int)
        return list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))

    def _enter(self, template: int, words: np.ndarray, runs: Iterable[int]) -> None:
        for r in runs:
            low, high = self.runs[r]
            known = self.places.setdefault((r, words[low:high].tobytes()), [])
            if not known or known[-1] != template:
                known.append(template)

    def _near(self, words: np.ndarray) -> np.ndarray | slice:
        """Templates that may share enough words, in their order."""
        n = len(self.names)
        if n < INDEXED:
            return slice(n)
        if self.places is None:
            self.places, self.runs = {}, self._runs()
            for t in range(n):
                self._enter(t, self.codes[t], range(len(self.runs)))
        found = [self.places.get((r, words[low:high].tobytes()), ()) for r, (low, high) in enumerate(self.runs)]
        return np.unique(np.concatenate([np.asarray(f, np.int64) for f in found]))

    def add(self, line: int, words: np.ndarray) -> int:
        """Number of the template that a line joins or begins."""
        n = len(self.names)
        if n:
            near = self._near(words)
            same = (self.codes[near] == words).sum(1)
            if len(same) and same[at := int(same.argmax())] >= self.least:
                best = at if isinstance(near, slice) else int(near[at])
                if same[at] < len(words):
                    changed = self.codes[best] != words
                    self.codes[best, changed] = _ANY_CODE
                    if self.places is not None:
                        self._enter(best, self.codes[best], [r for r, (low, high) in enumerate(self.runs) if changed[low:high].any()])
                return best
        if n == len(self.codes):
            self.codes = np.concatenate([self.codes, np.empty_like(self.codes)])
        self.codes[n] = words
        self.names.append(line)
        self.alone.append(True)
        if self.places is not None:
            self._enter(n, words, range(len(self.runs)))
        return n


CLUSTERED = "leaf bigint, line bigint, template bigint, codes array<smallint>"


def _templates(min_docs: int, similar: float):
    """Lines and their templates; rows come by group.

    Of a whole leaf (``open`` is false) only lines that recur themselves or share a template come out. Of a group of a larger
    leaf all lines come out, and each template once more with its words and no line, to meet those of other groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leaf, name_of_leaf, is_open = None, None, 0, False
        out: list[tuple[int, int | None, int, np.ndarray | None]] = []

        def close() -> None:
            if leaf is not None and is_open:
                out.extend((name_of_leaf, None, name, leaf.codes[t]) for t, name in enumerate(leaf.names))

        def written() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(columns[3], pa.list_(pa.int16()))]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["leaf", "line", "template", "codes"])

        for batch in batches:
            if not batch.num_rows:
                continue
            groups, leaves, lines, docs = (batch.column(c).to_numpy() for c in ("group", "leaf", "line", "n"))
            opens = batch.column("open").to_numpy(zero_copy_only=False)
            codes = batch.column("codes")
            widths = pc.list_value_length(codes).to_numpy()
            flat, ends = codes.flatten().to_numpy(), np.concatenate([[0], np.cumsum(widths)])
            new = (groups[1:] != groups[:-1]) | (widths[1:] != widths[:-1])
            starts = np.concatenate([[0], np.flatnonzero(new) + 1])
            heads = zip(groups[starts].tolist(), widths[starts].tolist(), leaves[starts].tolist(), opens[starts].tolist(), strict=True)
            cuts = [*starts.tolist(), len(groups)]
            for low, high, (key, width, name_here, open_here) in zip(cuts[:-1], cuts[1:], heads, strict=True):
                if (key, width) != last:
                    close()
                    last, name_of_leaf, is_open = (key, width), name_here, open_here
                    leaf = Leaf(width, similar)
                for k in range(low, high):
                    line = int(lines[k])
                    t = leaf.add(line, flat[ends[k] : ends[k + 1]])
                    name = leaf.names[t]
                    if is_open:
                        out.append((name_of_leaf, line, name, None))
                    elif name != line:
                        out.append((name_of_leaf, line, name, None))
                        if leaf.alone[t]:
                            out.append((name_of_leaf, name, name, None))
                            leaf.alone[t] = False
                    elif docs[k] >= min_docs:
                        out.append((name_of_leaf, name, name, None))
                        leaf.alone[t] = False
            yield written()
        close()
        yield written()

    return run


def _salted(many: DataFrame, few: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """Join on ``key``, of which one value may be in a large share of ``many``; ``by`` deals its rows over ``SALTS`` tasks."""
    salt = fresh("salt")
    each = few.withColumn(salt, F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    return many.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(each.hint("merge"), [key, salt], how).drop(salt)


def _large(rows: DataFrame, keys: list[str], limit: int, size: str) -> DataFrame:
    """Groups of more than ``limit`` rows; ``limit`` is a ten-thousandth of all rows at least, so they are 10,000 at most."""
    return F.broadcast(rows.groupBy(*keys).agg(F.count("*").alias(size)).where(F.col(size) > limit))


def _dealt(rows: DataFrame, turn: int, group: int) -> DataFrame:
    """Rows (leaf, line, codes, n) with their group, and whether the leaf has other groups.

    Large leaves are dealt evenly in turn 0 and by band ``turn - 1`` later.
    """
    limit = max(group, -(-rows.count() // 10_000))
    sized = rows.join(_large(rows, ["leaf"], limit, "size"), "leaf", "left")
    if turn:
        band = F.filter("codes", lambda _, i: (i >= DEPTH) & ((i - DEPTH) % BANDS == turn - 1))
        sized = sized.withColumn("band", F.when(F.col("size").isNotNull(), F.xxhash64(band)))
        held = _large(sized.where("band IS NOT NULL"), ["leaf", "band"], limit, "held")
        sized = sized.join(held, ["leaf", "band"], "left")
    else:
        sized = sized.withColumns({"band": F.when(F.col("size").isNotNull(), F.lit(0)).cast("bigint"), "held": F.col("size")})
    part = F.when(F.col("held").isNull(), 0).otherwise(F.pmod(F.xxhash64("line", F.lit(turn)), F.ceil(F.col("held") / limit)))
    return sized.select(
        F.when(F.col("size").isNull(), F.col("leaf")).otherwise(F.xxhash64("leaf", "band", part)).alias("group"), "leaf", "line", "codes", "n", F.col("size").isNotNull().alias("open")
    )


def _runs_of(words: Column, similar: float) -> Column:
    """(run, first place, length) of the runs of words after the leading ones, of which one agrees where lines share ``similar`` of their words.

    Lines of more than ``WIDE`` words have one empty run, in which all agree: they would come once for each of very many.
    """
    n = words - F.ceil(words * F.lit(similar)).cast("int") + 1
    places = F.greatest(words - DEPTH, F.lit(0))
    start = lambda r: (DEPTH + F.floor(r * places / n)).cast("int")
    run = lambda r, low, length: F.struct(r.alias("run"), low.alias("low"), length.alias("length"))
    runs = F.transform(F.sequence(F.lit(0), n - 1), lambda r: run(r, start(r), start(r + 1) - start(r)))
    return F.when(words > WIDE, F.array(run(F.lit(0), F.lit(DEPTH), F.lit(0)))).otherwise(runs)


def _nearest_older(similar: float):
    """For each template of a meeting the older one that it shares the most words with, if they are enough; the oldest of equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, lines, near, shared = [], [], [], []
            for leaf, words, names, flat in zip(*(batch.column(c) for c in ("leaf", "words", "lines", "codes")), strict=True):
                ids, width = names.values.to_numpy(), words.as_py()
                order = np.argsort(ids, kind="stable")
                ids, codes = ids[order], flat.values.to_numpy().reshape(-1, width)[order]
                step = max(1, CELLS // (len(ids) * width))
                for low in range(0, len(ids), step):
                    high = min(low + step, len(ids))
                    same = (codes[low:high, None] == codes[None, :high]).sum(2)
                    same[ids[None, :high] >= ids[low:high, None]] = -1
                    best = same.argmax(1)
                    most = same[np.arange(high - low), best]
                    for k in np.flatnonzero(most >= similar * width).tolist():
                        leaves.append(leaf.as_py())
                        lines.append(int(ids[low + k]))
                        near.append(int(ids[best[k]]))
                        shared.append(int(most[k]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (leaves, lines, near, shared)], ["leaf", "line", "near", "shared"])

    return run


def _older(rows: DataFrame, similar: float, limit: int) -> DataFrame:
    """(leaf, line, near): templates that share enough words with an older one of their leaf, and the nearest of those.

    All templates that agree in a run of words meet; of a run that more than ``limit`` agree in, every two blocks do.
    """
    words = F.size("codes")
    by_run = rows.select("leaf", "line", "codes", words.alias("words"), F.explode(_runs_of(words, similar)).alias("r"))
    key = F.xxhash64("r.run", F.slice(F.col("codes"), F.col("r.low") + 1, F.col("r.length")))
    by_run = by_run.select("leaf", "line", "codes", "words", key.alias("key"))
    parts = F.coalesce(F.ceil(F.col("held") / limit), F.lit(1)).cast("int")
    by_run = by_run.join(_large(by_run, ["leaf", "key"], limit, "held"), ["leaf", "key"], "left").withColumn("parts", parts)
    by_run = by_run.withColumn("part", F.pmod(F.xxhash64("line"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: (p != F.col("part")) | (F.col("parts") == 1))
    by_run = by_run.withColumn("other", F.explode(others))
    low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    met = by_run.groupBy("leaf", "words", "key", low, high).agg(F.collect_list("line").alias("lines"), F.flatten(F.collect_list("codes")).alias("codes"))
    found = met.where(F.size("lines") > 1).mapInArrow(_nearest_older(similar), "leaf bigint, line bigint, near bigint, shared bigint")
    return found.groupBy("leaf", "line").agg(F.min(F.struct(-F.col("shared"), "near")).alias("best")).select("leaf", "line", "best.near")


def _met(rows: DataFrame, turn: int, similar: float, group: int) -> DataFrame | None:
    """Rows like those of ``_dealt``, a group being templates of a large leaf with the older one that they are to join; none if no two share enough words.

    A template waits as long as the one it is to join is to join another itself, and if very many are to join one, most of them wait. At
    least one joins, so the turns end.
    """
    limit = max(group, -(-rows.count() // 10_000))
    sized = stored(rows.join(_large(rows, ["leaf"], limit, "size"), "leaf", "left"), "sized")
    older = stored(_older(sized.where("size IS NOT NULL"), similar, limit), "older")
    few = sized.where("size IS NULL")
    if older.isEmpty() and few.isEmpty():
        return None
    beyond = older.select("leaf", F.col("line").alias("near"), F.col("near").alias("beyond"))
    first = _salted(older, beyond.withColumnRenamed("leaf", "of"), "near", "line", "left").where("beyond IS NULL OR leaf != of").select("leaf", "line", "near")
    first = first.join(_large(first, ["leaf", "near"], limit, "held"), ["leaf", "near"], "left")
    now = first.where(F.col("held").isNull() | (F.pmod(F.xxhash64("line", F.lit(turn)), F.ceil(F.col("held") / limit)) == 0)).select("leaf", "line", "near")
    joined = sized.join(now.hint("merge"), ["leaf", "line"], "left")
    is_open = F.col("size").isNotNull()
    return joined.select(
        F.when(is_open, F.xxhash64("leaf", F.coalesce("near", "line"))).otherwise(F.col("leaf")).alias("group"), "leaf", "line", "codes", "n", is_open.alias("open")
    )


def clustered(distinct: DataFrame, *, min_docs: int = MIN_DOCS, similar: float = SIMILAR, group: int = GROUP) -> DataFrame:
    """(line, template) of the lines that recur themselves or share a template, from the distinct lines (leaf, line, codes, n)."""
    rows, members = stored(distinct, "lines"), None
    for turn in count():
        dealt = _dealt(rows, turn, group) if turn <= BANDS else _met(rows, turn, similar, group)
        if dealt is None:
            break
        dealt = dealt.repartition("group").sortWithinPartitions("group", F.size("codes"), "line")
        step = stored(dealt.mapInArrow(_templates(min_docs, similar), CLUSTERED), "templates")
        found = step.where("line IS NOT NULL").select("line", "template")
        if members is None:
            members = found
        else:
            # lines of templates that met no other keep theirs
            moved = found.select(F.col("line").alias("template"), F.col("template").alias("now")).where("template != now")
            both = _salted(members, moved, "template", "line", "left")
            members = stored(both.select("line", F.coalesce("now", "template").alias("template")), "members")
        rows = step.where("codes IS NOT NULL").select("leaf", F.col("template").alias("line"), "codes", F.lit(0).cast("bigint").alias("n"))
        if rows.isEmpty():
            break
    return members


def _known(line: Column) -> Column:
    """Whether a masked line has ``MIN_WORDS`` words: more than stand before the space that ends the last but one of them."""
    return F.substring_index(line, " ", MIN_WORDS - 1) != line


def _codes(line: Column) -> Column:
    """16-bit codes of a masked line's words."""
    plain = lambda w: (F.pmod(F.xxhash64(w), F.lit(65535)) - 32767).cast("smallint")
    words = F.split(line, " ")
    coded = F.transform(words, lambda w: F.when(w == ANY, F.lit(_ANY_CODE).cast("smallint")).otherwise(plain(w)))
    return F.when(F.contains(line, F.lit(ANY)), coded).otherwise(F.transform(words, plain))


def _leaf(line: Column) -> Column:
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.xxhash64(spaces, F.substring_index(line, " ", DEPTH))


def recurring(own: DataFrame, *, min_docs: int = MIN_DOCS, similar: float = SIMILAR, group: int = GROUP) -> DataFrame:
    """(doc_id, line): hashes of the masked lines of recurring templates, for each document that has one."""
    lines = own.where("doc_id IS NOT NULL").select("doc_id", F.explode(F.array_distinct(F.filter(masked(F.col("text")), _known))).alias("masked"))
    # texts are masked once: distinct lines and the documents of each are both read from here
    hashed = stored(lines.select("doc_id", F.xxhash64("masked").alias("line"), _leaf(F.col("masked")).alias("leaf"), _codes(F.col("masked")).alias("codes")), "hashed")
    distinct = hashed.groupBy("leaf", "line", "codes").agg(F.count("*").alias("n"))
    members = clustered(distinct, min_docs=min_docs, similar=similar, group=group)
    placed = _salted(hashed.select("doc_id", "line"), members, "line", "doc_id")
    often = placed.select("doc_id", "template").distinct().groupBy("template").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    return _salted(placed, often.select("template"), "template", "doc_id").select("doc_id", "line")


def drop_recurring_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, similar: float = SIMILAR, group: int = GROUP) -> DataFrame:
    """The columns of ``docs`` with cleaned texts, and ``n_lines`` and ``n_dropped``."""
    own = only(docs, **{doc_id: "doc_id", text: "text"}).where("text IS NOT NULL")
    mark, gone, lines = fresh("id"), fresh("gone"), fresh("lines")
    drop = recurring(own, min_docs=min_docs, similar=similar, group=group).groupBy(F.col("doc_id").alias(mark)).agg(F.collect_set("line").alias(gone))
    whole = F.col(f"`{text}`")
    out = docs.join(drop.hint("merge"), F.col(f"`{doc_id}`") == F.col(mark), "left")
    # texts that lose no line are neither masked nor put together again
    split = F.arrays_zip(F.split(whole, "\n").alias("line"), masked(whole).alias("masked"))
    kept = F.filter(F.col(lines), lambda x: ~(_known(x["masked"]) & F.array_contains(F.col(gone), F.xxhash64(x["masked"]))))
    out = out.withColumn(lines, F.when(F.col(gone).isNotNull(), split)).withColumn(mark, kept)
    n_lines = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    return out.withColumns(
        {
            "n_lines": F.coalesce(n_lines, F.lit(0)),
            "n_dropped": F.coalesce(F.when(F.col(mark).isNotNull(), F.size(lines) - F.size(mark)), F.lit(0)),
            text: F.when(F.col(mark).isNotNull(), F.array_join(F.col(f"{mark}.line"), "\n")).otherwise(whole),
        }
    ).drop(mark, gone, lines)
