"""Line deduplication by an exact set-similarity join (native).

A line's tokens are its distinct words (``[^\\x20\\x09-\\x0D]+``, A-Z lowered). A
line is removed when an earlier line -- by document id, then line number -- has
a token set with Jaccard similarity of ``similarity`` / 100 or more. Lines of any
length take part, one word (or one unspaced paragraph) included; ``min_tokens``
can leave shorter ones alone.

1. Words are counted over the whole table in ``1 << RANK_BITS`` hash buckets;
   the buckets' order by count is the rarity order. A token is one number: its
   bucket's rank above its hash, so sorted tokens run from rare to frequent.
2. Lines of equal sets form a class with its first line; all others go. A line
   earlier than the first of its class is needed to remove that one too.
3. Prefix filter: similar sets share one of their first
   ``n - ceil(similarity * n) + 1`` tokens. Classes meet on those (on the upper
   bits of them: what meets besides is parted later), under the
   length filter, the positional filter (the tokens after the meeting point
   must suffice) and a bitmap filter (the number of bits in which the sets'
   parity maps differ is at most the number of tokens in which they differ).
   Sets so small that only equal ones are similar have met as classes already.
   The meeting is a semi join: it tells which classes have a candidate and
   makes no pairs, however many classes share a token.
4. Only those classes fetch their lines' full tokens and meet again, now with
   the exact similarity and the order in the semi join's condition. Tokens on
   which the same classes met are one meeting.
5. Classes of more than ``HOT_LINES`` lines are few and go to the lines as a
   broadcast; the others' lines are shuffled.

Defined cases: a null text stays null and has no lines to remove; an empty text
or line stays; lines of one document count against each other; rows equal in
id and text count as one document and are cleaned alike; rows without an id
come after all others, in the order of a hash of their text; an empty table
gives no rows; lines of any length are whole; other columns are kept as they
are, except that names starting with ``_ld_`` are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapreel.llm.common import BROADCAST_ROWS, ascii_lower, counted, dropped, settled, staged

RANK_BITS = 14
HASH_BITS = 63 - RANK_BITS
SPACES = r"[\x20\x09-\x0D]+"       # fixed value: what separates words
MIN_TOKENS = 1
TOKEN_BITS = 40          # of a token, in the postings that are shuffled
HOT_LINES = 1000         # a larger class is not gathered by its hash
ORDER = ["none", "doc_id", "mark", "line"]


def _words(line: Column) -> Column:
    plain = ~(F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c")))
    # a split at one character needs no pattern
    return F.array_remove(F.when(plain, F.split(ascii_lower(line), " ")).otherwise(F.split(ascii_lower(line), SPACES)), "")


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _lines(documents: DataFrame) -> DataFrame:
    # the outer form: the inner one would split every text once more to test for lines
    return documents.select("doc_id", "mark", F.posexplode_outer(F.split("text", "\n")).alias("line", "words"))


def token_ranks(documents: DataFrame) -> list[int]:
    """Rank of each hash bucket by the number of words in it, all documents counted."""
    size = 1 << RANK_BITS
    bucket = F.xxhash64("word").bitwiseAND(F.lit(size - 1))
    # line by line: few lines need a pattern to be cut into words, but every text of several lines would
    words = _lines(documents).select(F.explode_outer(_words(F.col("words"))).alias("word"))
    counts = words.groupBy(bucket.alias("bucket")).count().collect()      # one number per bucket at most
    count = dict((r["bucket"], r["count"]) for r in counts)
    ranks = [0] * size
    for rank, b in enumerate(sorted(range(size), key=lambda b: (count.get(b, 0), b))):
        ranks[b] = rank
    return ranks


def _constant(numbers: list[int]) -> Column:
    """A list as one constant: a literal of each number would be a tree of thousands of nodes on the
    driver, made by as many calls and copied by every step of planning."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")


def _tokens(line: Column, ranks: list[int]) -> Column:
    """Sorted distinct tokens, rarest first."""
    known = _constant([rank << HASH_BITS for rank in ranks])

    def token(h):
        # never null, which lets Spark sort plain numbers; the place is always in the list
        rank = F.coalesce(F.get(known, h.bitwiseAND(F.lit((1 << RANK_BITS) - 1)).cast("int")), F.lit(0).cast("bigint"))
        return rank.bitwiseOR(F.shiftrightunsigned(h, 64 - HASH_BITS))
    hashes = F.transform(_words(line), lambda word: F.xxhash64(word))        # a function's argument is computed once
    return F.sort_array(F.transform(F.array_distinct(hashes), token))


def _prefix(n: Column, similarity: int) -> Column:
    return n - F.expr(f"({similarity} * n + 99) div 100") + 1


def _parity(tokens: Column, half: int) -> Column:
    """One half of a map of 128 bits in which every token flips one."""
    bits = [1 << i if i < 63 else -1 << 63 for i in range(64)]
    flips = _constant([0] * 64 + bits if half else bits + [0] * 64)

    def flip(map_, t):
        return map_.bitwiseXOR(F.get(flips, t.bitwiseAND(127).cast("int")))
    return F.aggregate(tokens, F.lit(0).cast("bigint"), flip)


def _meet(similarity: int) -> Column:
    """The filters on two postings ``x`` and ``y`` of one token (``pos`` 0 tests no position)."""
    need = _need(similarity)
    length = (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * similarity)
    after = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    differ = F.bit_count(F.col("x.low").bitwiseXOR(F.col("y.low"))) + F.bit_count(F.col("x.high").bitwiseXOR(F.col("y.high")))
    return length & (after >= need) & (differ <= F.col("x.n") + F.col("y.n") - 2 * need)


def _meet_packed(similarity: int) -> Column:
    """:func:`_meet` on postings whose size and place are one number."""
    n = {s: f"shiftright({s}.np, 32)" for s in "xy"}
    need = f"(({similarity} * ({n['x']} + {n['y']}) + {99 + similarity}) div {100 + similarity})"
    after = {s: f"{n[s]} - ({s}.np & 4294967295L)" for s in "xy"}
    return F.expr(
        f"least({n['x']}, {n['y']}) * 100 >= greatest({n['x']}, {n['y']}) * {similarity} AND least({after['x']}, {after['y']}) >= {need}"
        f" AND bit_count(x.low ^ y.low) + bit_count(x.high ^ y.high) <= {n['x']} + {n['y']} - 2 * {need}")


def _need(similarity: int) -> Column:
    """The least overlap: ceil(similarity * (n + m) / (100 + similarity))."""
    return F.expr(f"({similarity} * (x.n + y.n) + {99 + similarity}) div {100 + similarity}")


def removed_lines(docs: DataFrame, similarity: int = 80, min_tokens: int = MIN_TOKENS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, mark, removed``: numbers of the lines to remove, for documents that have any."""
    documents = _documents(docs, id_col, text_col)
    ranks = token_ranks(documents)
    # a generator of one row keeps the filter on the number of tokens above it: below, it would compute the tokens twice
    lines = _lines(documents).select("doc_id", "mark", "line", F.explode_outer(F.array(_tokens(F.col("words"), ranks))).alias("tokens"))
    lines = lines.select("doc_id", "mark", "line", F.size("tokens").alias("n"), "tokens",
                         F.xxhash64("tokens").alias("k1"), F.xxhash64(F.lit(1), "tokens").alias("k2"),
                         _parity(F.col("tokens"), 0).alias("low"), _parity(F.col("tokens"), 1).alias("high"))
    whole = staged(lines.select("doc_id", "mark", "line", "n", "k1", "k2", "low", "high",
                                F.slice("tokens", F.lit(1), _prefix(F.col("n"), similarity)).alias("prefix")).where(F.col("n") >= min_tokens), "lines")
    first = F.min(F.struct(*ORDER, "n", "low", "high", "prefix")).alias("first")
    classes = whole.withColumn("none", F.col("doc_id").isNull()).groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("size"))
    classes = settled(staged(classes.select("k1", "k2", "size", "first.*"), "line-classes"))
    lines = staged(whole.select("doc_id", "mark", "line", "k1", "k2"), "line-keys")
    dropped(whole)
    # a set that another size could match at all: n words against n + 1
    postings = classes.where(F.col("n") * 100 >= (F.col("n") + 1) * similarity)
    postings = postings.select("k1", "low", "high", "n", F.posexplode_outer("prefix").alias("pos", "token"))
    # the postings are the widest thing this operator shuffles: size and place are one number, tokens cut short
    postings = postings.select(F.shiftright("token", 63 - TOKEN_BITS).alias("token"), "k1", "low", "high",
                               (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("pos")).alias("np"))
    x, y = postings.alias("x"), postings.alias("y")
    meet = _meet_packed(similarity)
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.k1") != F.col("y.k1")) & meet, "left_semi").select("token", "k1")
    met = settled(staged(met, "line-meetings"))
    # tokens on which the same classes meet are one meeting: it is named by its members
    names = met.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.expr("bit_xor(xxhash64(k1))").alias("n1"),
                                     F.expr("bit_xor(xxhash64(k1, 1))").alias("n2"))
    meetings = staged(met.join(names, "token").select("k1", "m", "n1", "n2").distinct(), "line-named-meetings")
    dropped(met)
    chosen = settled(staged(classes.drop("prefix").join(meetings.select("k1").distinct(), "k1"), "line-candidates"))
    # of the other classes only those of several lines are needed any more, and no prefix
    several = staged(classes.where(F.col("size") > 1).select("k1", "k2", "size", *ORDER), "line-repeated")
    dropped(classes)

    wanted = chosen.select(F.col("doc_id").alias("w_id"), F.col("mark").alias("w_mark")).distinct()
    wanted = counted(staged(wanted, "line-wanted"))
    texts = documents.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("mark") == F.col("w_mark")), "left_semi")
    own = chosen.select("k1", "k2", "none", "n", "low", "high", F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark"), F.col("line").alias("c_line"))
    own = counted(own)
    full = _lines(texts).join(own, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("mark") == F.col("c_mark")) & (F.col("line") == F.col("c_line")))
    full = settled(staged(full.select("k1", "k2", *ORDER, "n", "low", "high", _tokens(F.col("words"), ranks).alias("tokens"))
                  .dropDuplicates(["k1", "k2"]), "line-tokens"))      # repeated rows bring their line again
    # in a meeting, the first line has no earlier one to match and the last is earlier than none
    placed = meetings.join(full.select("k1", F.struct(*ORDER).alias("at")), "k1")
    ends = placed.groupBy("m", "n1", "n2").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    placed = placed.join(ends, ["m", "n1", "n2"]).select("k1", "m", "n1", "n2", (F.col("at") > F.col("lo")).alias("later"),
                                                         (F.col("at") < F.col("hi")).alias("earlier"))
    placed = staged(placed, "line-places")
    body = full.select("k1", "k2", F.struct(*ORDER).alias("at"), "n", "low", "high", "tokens", F.lit(0).alias("pos"))
    x = body.join(placed.where("later"), "k1").alias("x")
    y = body.join(placed.where("earlier"), "k1").alias("y")
    one = (F.col("x.n1") == F.col("y.n1")) & (F.col("x.n2") == F.col("y.n2")) & (F.col("x.m") == F.col("y.m"))
    same = F.size(F.array_intersect("x.tokens", "y.tokens")) >= _need(similarity)
    matched = x.join(y, one & _meet(similarity) & (F.col("y.at") < F.col("x.at")) & same, "left_semi").select("k1", "k2").distinct()

    matched = staged(matched, "line-matched")
    single = chosen.where(F.col("size") == 1).select("k1", "k2", "size", *ORDER).join(matched, ["k1", "k2"], "left_semi")
    heads = several.join(matched.withColumn("matched", F.lit(True)), ["k1", "k2"], "left").unionByName(single.withColumn("matched", F.lit(True)))
    heads = heads.select("k1", "k2", "size", "matched", *[F.col(c).alias(f"h_{c}") for c in ORDER])
    heads = settled(staged(heads, "line-heads"))                                                    # the other classes lose nothing
    for table in (meetings, full, placed):
        dropped(table)
    head = F.col("doc_id").eqNullSafe(F.col("h_doc_id")) & (F.col("mark") == F.col("h_mark")) & (F.col("line") == F.col("h_line"))
    hot, rest = staged(heads.where(F.col("size") > HOT_LINES), "line-hot-heads"), heads.where(F.col("size") <= HOT_LINES)
    known = lines.join(counted(hot), ["k1", "k2"]).unionByName(
        lines.join(counted(hot.select("k1", "k2")), ["k1", "k2"], "left_anti").join(counted(rest), ["k1", "k2"]))
    gone = known.where(~head | F.col("matched"))
    return gone.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("removed"))


def deduplicate_lines(docs: DataFrame, similarity: int = 80, min_tokens: int = MIN_TOKENS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut from its text, and ``_ld_lines``, ``_ld_removed`` counts."""
    gone = staged(removed_lines(docs, similarity, min_tokens, id_col, text_col), "line-removals")
    gone = gone.select(F.col("doc_id").alias("_ld_id"), F.col("mark").alias("_ld_mark"), F.col("removed").alias("_ld_gone"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    if gone.agg(F.coalesce(F.sum(F.size("_ld_gone")), F.lit(0))).first()[0] <= 4 * BROADCAST_ROWS:
        gone = counted(gone)
    on = F.col(id_col).cast("bigint").eqNullSafe(F.col("_ld_id")) & (F.xxhash64(text) == F.col("_ld_mark"))
    joined = docs.join(gone, on, "left")
    lines = F.split(F.col(text_col), "\n")
    left = F.array_join(F.filter(lines, lambda w, i: ~F.array_contains("_ld_gone", i)), "\n")
    cleaned = F.when(F.col("_ld_gone").isNull(), F.col(text_col)).otherwise(left)
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns],
                         F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).alias("_ld_lines"),
                         F.when(F.col("_ld_gone").isNull(), 0).otherwise(F.size("_ld_gone")).alias("_ld_removed"))


def cut_lines(docs: DataFrame, text_col: str = "text", **parameters) -> DataFrame:
    """``docs`` with its own columns and cleaned text, without documents that lost their last word."""
    out = deduplicate_lines(docs, text_col=text_col, **parameters)
    left = F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]"))
    return out.where((F.col("_ld_removed") == 0) | (left > 0)).select(*docs.columns)
