"""Line dedup: a segment-partition edit join over the distinct lines of a corpus.

A line within one edit of another shares one of its two halves with it, at a place that the two
lengths fix. Lines meet by hashed halves, probing their own length and one less. Where many lines
share a half, the rest of the line is cut into parts of which all but one must agree, again and
again, until few lines share a key or a single character is left, where sharing the key is proof.
Pairs from small groups are verified by a banded bit-parallel edit distance.

A higher threshold of k edits cuts the shorter line of a pair into k + 1 segments, one of which the
longer line holds unchanged near its place. Segments are the same for a bucket of lengths. Lines probe
for the segments of all buckets that hold lines they may be k longer than, at the shifts that edits
left and right of a segment allow.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import key_filter, maybe_in
from parley.session import staged

EDITS = 1
#: Threshold of the registered queries: 5 % of a line's length, one edit at least and 7 at most.
NEAR = {"edits": 7, "percent": 5}
#: Shorter lines are compared for equality only.
LEAST_CHARS = 20
#: Lines of one key that are compared pair by pair; above that the key is refined.
GROUP = 16
PARTS = 8
LINE = ["k1", "k2"]
#: Characters that a line's sketch counts; others bound nothing.
COUNTED = " etaoinsrhldcumgpf0123"
#: 64-bit words of the filter on segments, and the bits of a word that a segment sets.
SEGMENT_WORDS = 1 << 21
SEGMENT_MARKS = 3
#: Lengths are cut up alike in buckets of so many characters; a line's segments lie in the first SPAN
#: characters, or in so many more as it takes to reach the highest threshold.
BUCKET = 20
SPAN = 240


def within(a: Column, b: Column, limit: int) -> Column:
    """Whether the edit distance of two strings is ``limit`` at most.

    Bit k of each word stands for the row ``i + k - limit`` of column ``i``: a band of
    2 * limit + 1 cells around the diagonal, updated by a few word operations a character.
    """
    start_alike = F.lit("." * (limit + 1))  # changes no distance, and gives the band room
    a, b = F.concat(start_alike, a), F.concat(start_alike, b)
    width = 2 * limit + 1
    mask = F.lit((1 << width) - 1).cast("long")
    zero = F.lit(0).cast("long")

    def matches(strings: Column) -> Column:
        """For each character of b, the cells of the band in which it meets the same in a."""

        def cells(c: Column, i: Column) -> Column:
            same = [F.when(F.get(strings["a"], i + (k - limit)) == c, F.lit(1 << k)).otherwise(0) for k in range(width)]
            return sum(same, F.lit(0)).cast("long")

        return F.transform(strings["b"], cells)

    def run(masks: Column) -> Column:
        turn = F.char_length(a) - limit  # from here on the last row is followed along the band

        def step(s: Column, match: Column) -> Column:
            vp, vn, i = s["vp"], s["vn"], s["i"]
            d = (match.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(match).bitwiseOR(vn).bitwiseAND(mask)
            up = vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp))).bitwiseAND(mask)
            down = d.bitwiseAND(vp)
            half = F.shiftrightunsigned(d, 1)
            place = F.greatest(F.lit(width - 2) - (i - turn), F.lit(0))
            along = _bit(up, place) - _bit(down, place)
            more = F.when(i < turn, 1 - _bit(d, F.lit(width - 1))).otherwise(along)
            return F.struct(
                down.bitwiseOR(F.bitwise_not(half.bitwiseOR(up))).bitwiseAND(mask).alias("vp"),
                half.bitwiseAND(up).alias("vn"),
                (s["dist"] + more).alias("dist"),
                (i + 1).alias("i"),
            )

        start = F.struct(
            F.lit(((1 << limit + 1) - 1) << limit).cast("long").alias("vp"),
            zero.alias("vn"),
            F.lit(limit).cast("long").alias("dist"),
            F.lit(0).alias("i"),
        )
        return F.aggregate(masks, start, step, lambda s: s["dist"] <= limit)

    strings = F.struct(_characters(a).alias("a"), _characters(b).alias("b"))
    apart = F.abs(F.char_length(a) - F.char_length(b)) > limit
    return F.when(apart, False).otherwise(_let(strings, lambda s: _let(matches(s), run)))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _bit(word: Column, at: Column) -> Column:
    return F.call_function("shiftrightunsigned", word, at.cast("int")).bitwiseAND(F.lit(1).cast("long"))


def corpus_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, pos, line, k1, k2) of every line that isn't blank. Null texts have none."""
    line = F.col("line")
    return (
        docs.filter("text is not null")
        .select("doc_id", F.xxhash64("text").alias("doc_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .filter(F.trim(line) != "")
        .withColumns({"k1": F.xxhash64(line), "k2": F.xxhash64(F.lit(EDITS), line)})
    )


def _place() -> Column:
    """Where a line stands in the corpus: by doc_id (null last), a hash of the text, position."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_hash", "pos")


def _key(line: str, length: str, begin: str, end: str, longer: str) -> Column:
    """Hash of all of a line but characters ``begin`` to ``end`` (one more for a ``longer`` line).

    ``length`` is that of the shorter of the two lines that are to meet.
    """
    return F.expr(
        f"xxhash64({length}, {begin}, {end}, left({line}, {begin}), substring({line}, {end} + {longer} + 1))"
    )


def distinct_lines(docs: DataFrame, halved_to: int | None = None) -> DataFrame:
    """(k1, k2, n_chars, first, copies, half_keys): each distinct line, where it stands first.

    Lines of more than ``halved_to`` characters get no half keys.
    """
    n = F.char_length("line")
    sized = corpus_lines(docs).withColumns(
        {
            "n_chars": n,
            "short": n - 1,
            "mid": F.floor(n / 2).cast("int"),
            "mid_short": F.floor((n - 1) / 2).cast("int"),
            "zero": F.lit(0),
            "one": F.lit(1),
        }
    )
    keys = F.array(
        _key("line", "n_chars", "mid", "n_chars", "zero"),
        _key("line", "n_chars", "zero", "mid", "zero"),
        _key("line", "short", "mid_short", "short", "one"),
        _key("line", "short", "zero", "mid_short", "one"),
    )
    halved = n >= LEAST_CHARS if halved_to is None else n.between(LEAST_CHARS, halved_to)
    named = sized.select(*LINE, "n_chars", _place().alias("place"), F.when(halved, keys).alias("half_keys"))
    return named.groupBy(*LINE, "n_chars").agg(
        F.min("place").alias("first"), F.count("*").alias("copies"), F.any_value("half_keys").alias("half_keys")
    )


def half_rows(unique: DataFrame) -> DataFrame:
    """(k1, k2, first, n, longer, begin, end, key): the keys of each line's two halves.

    ``n`` is the length of the shorter line meant, ``longer`` 1 for a line that probes for lines one
    shorter than itself; characters ``begin`` to ``end`` are those left open.
    """
    rows = unique.filter("half_keys is not null").select(
        *LINE, "first", "n_chars", F.posexplode("half_keys").alias("which", "key")
    )
    n, longer = F.expr("n_chars - which div 2"), F.expr("which div 2")
    rows = rows.withColumns({"n": n.cast("int"), "longer": longer.cast("int")})
    mid = F.floor(F.col("n") / 2).cast("int")
    first_half = F.col("which") % 2 == 0
    return rows.select(
        *LINE,
        "first",
        "n",
        "longer",
        F.when(first_half, mid).otherwise(0).alias("begin"),
        F.when(first_half, F.col("n")).otherwise(mid).alias("end"),
        "key",
    )


def _meeting(rows: DataFrame) -> DataFrame:
    """(key, shorter, longer_): keys at which two lines can meet, and how many lines of each kind."""
    counts = rows.groupBy("key").agg(
        F.sum(1 - F.col("longer")).alias("n_base"), F.sum("longer").alias("n_longer")
    )
    return counts.filter("n_base > 1 or (n_base > 0 and n_longer > 0)")


def near_lines(docs: DataFrame, unique: DataFrame) -> DataFrame:
    """(k1, k2) of distinct lines that have an earlier line within one edit."""
    meeting = staged(_meeting(half_rows(unique)), "line-keys")
    rows = maybe_in(half_rows(unique), "key", key_filter(meeting, "key")).filter("maybe").drop("maybe")
    rows = staged(rows.join(meeting, "key"), "line-halves")
    wanted = rows.select(*LINE).distinct()
    lines = maybe_in(corpus_lines(docs).select(*LINE, "line"), "k1", key_filter(wanted, "k1"))
    texts = lines.filter("maybe").join(wanted, LINE, "left_semi").groupBy(*LINE).agg(F.any_value("line").alias("line"))
    rows = staged(rows.join(texts, LINE), "line-rows")

    later = None
    while True:
        small = rows.filter(F.col("n_base") + F.col("n_longer") <= GROUP)
        large = rows.filter(F.col("n_base") + F.col("n_longer") > GROUP)
        found = _verified(small).union(_proven(large))
        later = found if later is None else later.union(found)
        parts = staged(_refined(large), "line-parts")
        meeting = staged(_meeting(parts), "line-keys")
        if meeting.isEmpty():
            return later.distinct()
        rows = staged(parts.join(meeting, "key"), "line-rows")


def _verified(rows: DataFrame) -> DataFrame:
    """The later line of every pair of a small group that is within one edit.

    All but the open parts agree, so these are compared; one half of them must agree as well.
    """
    part = F.expr("substring(line, begin + 1, end - begin + longer)").alias("part")
    sides = rows.select("key", "first", "longer", (F.col("end") - F.col("begin")).alias("open"), part, *LINE)
    a = sides.select("key", "open", *[F.col(c).alias(f"{c}_a") for c in ("first", "longer", "part")])
    b = sides.select("key", *[F.col(c).alias(f"{c}_b") for c in ("first", "longer", "part")], *LINE)
    half = "open div 2"
    near = F.expr(
        f"left(part_a, {half}) = left(part_b, {half})"
        f" or substring(part_a, {half} + longer_a + 1) = substring(part_b, {half} + longer_b + 1)"
    )
    pairs = a.join(b, "key").filter("first_a < first_b and longer_a + longer_b < 2").filter(near)
    shorter_first = F.col("longer_a") <= F.col("longer_b")
    x = F.when(shorter_first, F.col("part_a")).otherwise(F.col("part_b"))
    y = F.when(shorter_first, F.col("part_b")).otherwise(F.col("part_a"))
    apart = pairs.select(x.alias("x"), y.alias("y"), *LINE).distinct()
    return apart.filter(within(F.col("x"), F.col("y"), EDITS)).select(*LINE)


def _proven(rows: DataFrame) -> DataFrame:
    """Later lines of groups in which the key alone is proof.

    One open character: lines of one length differ in that character at most. No open character: the
    longer lines have just one character more.
    """
    open_ = F.col("end") - F.col("begin")
    base = rows.filter((open_ == 1) & (F.col("longer") == 0))
    ends = rows.filter(open_ == 0)
    first_base = base.groupBy("key").agg(F.min("first").alias("lead"))
    one = base.join(first_base, "key").filter("first > lead").select(*LINE)
    leads = ends.groupBy("key", (1 - F.col("longer")).alias("longer")).agg(F.min("first").alias("lead"))
    none = ends.join(leads, ["key", "longer"]).filter("first > lead").select(*LINE)
    return one.union(none)


def _refined(rows: DataFrame) -> DataFrame:
    """The next rows of large groups: the open part cut up, all but one cut must agree."""
    wide = F.expr(
        f"transform(sequence(0, least({PARTS}, end - begin) - 1), i -> named_struct("
        f"'b', begin + cast(i * (end - begin) div least({PARTS}, end - begin) as int), "
        f"'e', begin + cast((i + 1) * (end - begin) div least({PARTS}, end - begin) as int)))"
    )
    edges = F.expr("array(named_struct('b', begin, 'e', begin), named_struct('b', end, 'e', end))")
    open_ = F.col("end") - F.col("begin")
    parts = (
        rows.filter((open_ > 1) | ((open_ == 1) & (F.col("n_longer") > 0)))
        .withColumn("cut", F.explode(F.when(open_ > 1, wide).otherwise(edges)))
        .withColumns({"begin": F.col("cut.b"), "end": F.col("cut.e")})
    )
    key = _key("line", "n", "begin", "end", "longer").alias("key")
    return parts.select(*LINE, "first", "n", "longer", "begin", "end", key, "line")


def _limit(length: str, edits: int, percent: int | None) -> str:
    """SQL for how many edits a line may be from one of ``length`` that is no longer."""
    return f"{edits}" if percent is None else f"greatest({EDITS}, least({edits}, int({length} * {percent} div 100)))"


def _shape(bucket: int, edits: int, percent: int | None) -> tuple[int, int]:
    """(k, size) for lengths of a bucket: their highest threshold and the size of the k + 1 segments."""
    top = max(SPAN // BUCKET, 0 if not percent else -(-100 * edits // (percent * BUCKET)))
    longest = BUCKET * bucket + BUCKET - 1
    k = edits if percent is None else max(EDITS, min(edits, longest * percent // 100))
    return k, BUCKET * min(bucket, top) // (k + 1)


def _cut_from(edits: int, percent: int | None) -> int | None:
    """The length from which ``segment_rows`` cuts the shorter line of a pair; None where it cuts none."""
    if edits <= EDITS or percent == 0:
        return None
    bucket = LEAST_CHARS // BUCKET
    while _shape(bucket, edits, percent)[0] <= EDITS:
        bucket += 1
    return BUCKET * bucket


def _segments(edits: int, percent: int | None, probes: bool) -> list[list[dict]]:
    """For each length, the substrings that are its segments, or that may be those of other lines.

    Lengths from the last bucket on are like those of the last bucket. In a pair within k edits there
    is a segment i of the shorter line with i edits to its left and k - i at most to its right.
    """
    backs = edits // BUCKET + 2 if probes else 1
    last = SPAN // BUCKET
    while percent and _shape(last, edits, percent)[0] < edits:
        last += 1
    out = []
    for n in range(BUCKET * (last + backs)):
        found = []
        for back in range(backs):
            bucket = n // BUCKET - back
            k, size = _shape(bucket, edits, percent)
            if bucket < LEAST_CHARS // BUCKET or k <= EDITS:
                continue
            least, most = max(0, n - BUCKET * bucket - BUCKET + 1), min(k, n - BUCKET * bucket)
            for i in range(k + 1):
                shifts = range(max(-i, least - k + i), min(i, most + k - i) + 1) if probes else [0]
                for s in shifts:
                    if not probes or back or s:  # a line's own segments are rows already
                        found.append({"back": back, "i": i, "start": i * size + s, "size": size})
        out.append(found)
    return out


def _found(edits: int, percent: int | None, probes: bool) -> Column:
    """The entry of ``_segments`` for a line of ``n`` characters."""
    table = _segments(edits, percent, probes)
    segments = F.from_json(F.lit(json.dumps(table)), "array<array<struct<back:int,i:int,start:int,size:int>>>")
    return F.get(segments, F.expr(f"int(least(n div {BUCKET}, {len(table) // BUCKET - 1}) * {BUCKET} + n % {BUCKET})"))


def _segment_key(s: Column) -> Column:
    """Hash of a segment ``s`` of ``line``, with its number and the bucket of lengths it is for."""
    part = F.substring("line", s["start"] + 1, s["size"])
    return F.xxhash64(F.expr(f"int(n div {BUCKET})") - s["back"], s["i"], part)


def segment_rows(lines: DataFrame, edits: int, percent: int | None, probes: bool) -> DataFrame:
    """(key, k1, longer): the segments of each line, or those of other lines that it may hold.

    They depend on the shorter line's bucket of lengths, so a line probes two buckets at most and not
    each length. Only buckets with a threshold over one edit are cut; ``longer`` is 1 for probes.
    """
    lines = lines.select("k1", "line", F.char_length("line").alias("n")).filter(f"n >= {LEAST_CHARS}")
    found = _found(edits, percent, probes)
    rows = lines.withColumn("s", F.explode(found))
    key = _segment_key(F.col("s"))
    return rows.select(key.alias("key"), "k1", F.lit(int(probes)).alias("longer"))


def sketch(line: str) -> Column:
    """How often some letters occur. An edit takes away one character and brings one at most."""
    size = F.length(line)
    return F.array(*[size - F.length(F.replace(F.col(line), F.lit(c), F.lit(""))) for c in COUNTED])


def sketch_distance() -> str:
    """SQL for how far the counts of a pair are apart: twice the edits at most."""
    return "(" + " + ".join(f"abs(sketch_a[{i}] - sketch[{i}])" for i in range(len(COUNTED))) + ")"


def apart(a: str, b: str, limit: str) -> Column:
    """The edit distance of two strings, -1 where it is over ``limit`` (SQL).

    Eighths of the shorter one that both have at the beginning or the end are left out, which changes nothing.
    """
    size = f"int(least(char_length({a}), char_length({b})) div {PARTS})"

    def alike(start: str) -> str:
        """SQL for the length of the eighths that agree in a row; ``start`` is where each begins."""
        cases = [
            f"when substring({a}, {start.format(a, i, size)}, {size}) <> substring({b}, {start.format(b, i, size)}, {size}) then {i}"
            for i in range(PARTS)
        ]
        return f"{size} * (case {' '.join(cases)} else {PARTS} end)"

    ends = F.struct(
        F.expr(alike("{1} * {2} + 1")).alias("ahead"),
        F.expr(alike("char_length({0}) - ({1} + 1) * {2} + 1")).alias("behind"),
        F.expr(f"{PARTS} * {size}").alias("most"),
    )

    def rest(t: Column) -> Column:
        behind = F.least(t["behind"], t["most"] - t["ahead"])  # no character is left out twice
        left = [F.substring(F.col(c), t["ahead"] + 1, F.char_length(c) - t["ahead"] - behind) for c in (a, b)]
        return F.call_function("levenshtein", *left, F.expr(limit))

    return _let(ends, rest)


def far_lines(docs: DataFrame, unique: DataFrame, edits: int, percent: int | None) -> DataFrame:
    """(k1, k2) of distinct lines that have an earlier line within a threshold of two edits or more.

    In a large group all lines are compared with the first one; then only those that it doesn't
    explain are compared with all others, and only where their sketches are near enough.
    """
    lines = corpus_lines(docs).select("k1", "line")
    base = segment_rows(lines, edits, percent, probes=False)
    probes = segment_rows(lines, edits, percent, probes=True)
    held = key_filter(base, "key", SEGMENT_WORDS, SEGMENT_MARKS)
    probes = maybe_in(probes, "key", held, SEGMENT_WORDS, SEGMENT_MARKS).filter("maybe").drop("maybe")
    probes = staged(probes, "line-probes")
    both = base.union(probes)
    # repeats of one line don't meet
    shared = both.groupBy("key").agg(F.min("k1").alias("low"), F.max("k1").alias("high"), F.min("longer").alias("kind"))
    shared = staged(shared.filter("kind = 0 and low <> high").select("key"), "line-segment-keys")
    met = key_filter(shared, "key", SEGMENT_WORDS, SEGMENT_MARKS)
    rows = maybe_in(both, "key", met, SEGMENT_WORDS, SEGMENT_MARKS).filter("maybe").drop("maybe").distinct()
    rows = staged(rows.join(shared, "key", "left_semi"), "line-segment-rows")
    places = unique.select(*LINE, "first", "n_chars")
    rows = staged(rows.join(_meeting(rows), "key").join(places, "k1"), "line-segments")

    wanted = rows.select(*LINE).distinct()
    texts = maybe_in(corpus_lines(docs).select(*LINE, "line"), "k1", key_filter(wanted, "k1")).filter("maybe")
    texts = texts.join(wanted, LINE, "left_semi").groupBy(*LINE).agg(F.any_value("line").alias("line"))
    own = F.transform(_found(edits, percent, probes=False), _segment_key)
    texts = texts.withColumn("n", F.char_length("line")).withColumns({"sketch": sketch("line"), "own": own}).drop("n")
    texts = staged(texts, "line-segment-texts")
    rows = rows.join(texts.select(*LINE, "sketch", "own"), LINE)

    def later_of(pairs: DataFrame) -> DataFrame:
        """The later line of those pairs (k1_a, k2_a, earlier; k1, k2) that are within the threshold."""
        b = texts.select(*LINE, "line")
        a = b.toDF("k1_a", "k2_a", "line_a")
        pairs = pairs.select("k1_a", "k2_a", *LINE).distinct().join(a, ["k1_a", "k2_a"]).join(b, LINE)
        limit = _limit("least(char_length(line_a), char_length(line))", edits, percent)
        return pairs.filter(apart("line_a", "line", limit) >= 0).select(*LINE).distinct()

    def pairs_of(a: DataFrame, b: DataFrame) -> DataFrame:
        """Pairs that may be near. Lines that share segments of their own are paired at one of these."""
        a = a.select("key", *[F.col(c).alias(f"{c}_a") for c in (*LINE, "first", "longer", "n_chars", "sketch", "own")])
        pairs = a.join(b, "key").filter("first_a < first and longer_a + longer < 2")
        budget = _limit("least(n_chars_a, n_chars)", edits, percent)
        close = f"abs(n_chars_a - n_chars) <= {budget} and {sketch_distance()} <= 2 * {budget}"
        # one comparison, so that the arrays of close pairs only are compared
        return pairs.filter(f"key = if({close}, coalesce(array_min(array_intersect(own_a, own)), key), null)")

    size = F.col("n_base") + F.col("n_longer")
    large = rows.filter(size > GROUP)
    lead = large.groupBy("key").agg(F.min(F.struct("first", *LINE)).alias("lead"))
    led = large.join(lead.select("key", "lead.first", "lead.k1", "lead.k2").toDF("key", "first_a", "k1_a", "k2_a"), "key")
    led = staged(later_of(led.filter("first_a < first")), "line-led")
    small = rows.filter(size <= GROUP).join(led, LINE, "left_anti")
    rest = large.join(led, LINE, "left_anti")
    found = pairs_of(rows.filter(size <= GROUP), small).select("k1_a", "k2_a", *LINE)
    return later_of(found.union(pairs_of(large, rest).select("k1_a", "k2_a", *LINE))).union(led).distinct()


def line_dedup(docs: DataFrame, edits: int = EDITS, percent: int | None = None) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, plus n_lines and n_dropped.

    A line goes when an earlier line of the corpus equals it, or, for lines of 20 characters or more,
    is within ``edits`` (insertions, deletions or substitutions of a character) of it; with
    ``percent``, also within that share of the shorter one's length, or one edit. Earlier means by
    doc_id (null last), then a hash of the text, then position. Blank lines stay and aren't counted.
    Lines end at ``\\n`` only. Rows that agree in doc_id and text are one document and end up alike.
    Null and empty texts stay as they are, with no lines; very long lines are handled like any
    other. Columns of ``docs`` keep their place, ``n_chars`` follows the text where there is one, and
    columns named n_lines or n_dropped are replaced. No rows give no rows.
    """
    if "maybe" in docs.columns:  # a working column has that name
        out = line_dedup(docs.withColumnRenamed("maybe", "_own_maybe"), edits, percent)
        return out.withColumnRenamed("_own_maybe", "maybe")
    cut_from = _cut_from(edits, percent)
    unique = staged(distinct_lines(docs, cut_from), "line-unique")  # the longer of two may be one longer
    if cut_from is None:
        near = near_lines(docs, unique)
    else:
        near = far_lines(docs, unique, edits, percent)
        if cut_from > LEAST_CHARS:
            near = near.union(staged(near_lines(docs, unique), "line-one-edit")).distinct()
    near = staged(near, "line-near").withColumn("near", F.lit(True))
    marked = unique.select(*LINE, "first", "copies").join(near, LINE, "left")
    marked = staged(marked.filter("copies > 1 or near"), "line-marked").select(*LINE, "first", "near")
    lines = maybe_in(corpus_lines(docs).drop("line"), "k1", key_filter(marked, "k1")).filter("maybe")
    repeats = lines.join(marked, LINE).filter(F.coalesce("near", F.lit(False)) | (_place() != F.col("first")))
    document = ["doc_id", "doc_hash"]
    dropped = repeats.groupBy(*document).agg(F.collect_set("pos").alias("_gone"))
    dropped = staged(dropped.withColumn("doc_key", F.xxhash64(*document)), "line-dropped")

    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text_hash = F.xxhash64("text")
    hashed = docs.select(*columns, text_hash.alias("_hash"), F.xxhash64("doc_id", text_hash).alias("_key"))
    known = maybe_in(hashed, "_key", key_filter(dropped, "doc_key"))
    same = known["doc_id"].eqNullSafe(dropped["doc_id"]) & (known["_hash"] == dropped["doc_hash"])
    hit = known.filter("maybe and text is not null").join(
        dropped, (known["_key"] == dropped["doc_key"]) & same, "left"
    ).select(*[known[c] for c in columns], "_gone")
    rest = known.filter("not maybe or text is null").select(*columns, F.lit(None).cast("array<int>").alias("_gone"))
    both = hit.union(rest)
    kept = F.array_join(
        F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n"
    )
    count = F.size(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).cast("long")
    out = both.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(count),
            "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
            "_text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept),
        }
    )
    changed = {"text": F.col("_text")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        size = F.char_length("_text").cast(kind)
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, size).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*columns, "n_lines", "n_dropped")
