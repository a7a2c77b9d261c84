"""Personal data: fixed patterns as seeds, and contextual patterns learned from them, with DataFrame functions only.

Seeds are the matches of four fixed patterns (email, ip, card, phone). The words around them, in lower case and without the
signs around them, form lexical patterns: the word before (L), the word after (R), both (B), and the two words before (T).
A pattern that stands around ``SUPPORT`` different seeds of a kind is kept. A pattern of one word must have done so in as many
different surroundings, and its word must not be an ordinary one, with a seed beside it in less than ``FLOOR`` of its places;
one of two words must do so in ``FLOOR`` of the places, at least, where chance alone would bring its words together. What else stands in the slots of kept patterns are unknown
instances: of B all of up to ``FEW`` words between, of the others one word, or a run of up to ``FEW`` number words.

Patterns and instances form a graph that is scored in rounds. The trust in a pattern for a kind is the share of its seeds
of that kind among its seeds of all kinds and its unknown instances, which weigh ``ALPHA`` of a seed and count for the
kind with the score that other patterns give them; so no pattern vouches for itself. An instance's score is that at
least one of its patterns is right. Values of ``ACCEPT`` or more, unless they occur elsewhere more than ``COMMON`` times as often
as in a slot, become spans of that kind wherever they occur, whatever their case and the signs around them.

Positions are code points. Null and empty texts have no spans; very long texts and words are read whole. Repeated rows are
treated alike; of kinds with equal scores the last by name is taken. An empty table gives no rows. ``masked`` keeps all columns; the
other functions read doc_id and text only, whatever other columns there are. Words that hold U+E000, the
filler that stands for seeds, are never instances.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import SMALL_TABLE, small_table
from meterline.session import cut

KINDS = ["email", "ip", "card", "phone"]
_W = r"\x20\x09-\x0D"
#: A match starts where one may: after the last match or after a character that it could not begin with. The
#: possessive signs keep very long runs linear and change no match.
_FIXED = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Signs around a word that are not part of it, the blanks, and the filler that stands for seeds.
_SIGNS, _BLANKS, _FILLER = ".,;:!?\"'()[]{}<>", " \t\n\x0b\x0c\r", "\ue000"
#: Cheap tests that every text with a match passes.
_MAY = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){15}"),
    "phone": lambda t: t.contains("+"),
}
ROUNDS, SUPPORT, FLOOR, ALPHA, ACCEPT, COMMON, FEW = 4, 3, 0.02, 0.25, 0.75, 5, 5
#: Words that are looked for in one pass over the texts (those are broadcast); more of them take more passes.
AT_ONCE = 200_000
_SPANS = "array<struct<s:int,e:int,v:string>>"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    """The digits from the right, every second one doubled, its two digits added, sum to a multiple of ten."""
    each = F.transform(F.split(F.reverse(_digits(v)), ""), lambda d, i: F.element_at(
        F.when(i % 2 == 0, F.array(*[F.lit(k) for k in range(10)])).otherwise(F.array(*[F.lit(k) for k in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])),
        d.cast("int") + 1,
    ))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z"),
    "card": lambda v: F.when(F.length(_digits(v)).between(16, 19), _luhn(v)).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}


def spans(text: Column, kind: str) -> Column:
    """Start, end and text of the matches of a kind: the lengths of matches and of what lies between are summed up."""
    found = F.regexp_extract_all(text, F.lit(_FIXED[kind]), F.lit(0))
    gaps = F.transform(F.split(text, _FIXED[kind], -1), F.length)
    steps = F.zip_with(found, F.slice(gaps, 1, F.greatest(F.size(found), F.lit(1))), lambda v, g: F.struct(v.alias("v"), g.alias("g")))
    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["g"]
        e = s + F.length(x["v"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))).alias("out"))

    all_ = F.aggregate(F.filter(steps, lambda x: x["v"].isNotNull()), start, step, lambda acc: acc["out"])
    return F.when(_MAY[kind](text), F.filter(all_, lambda x: _VALID[kind](x["v"]))).otherwise(none)


#: A word: what lies between blanks, without the signs around it.
_QUOTED = "".join("\\" + c for c in _SIGNS)
_WORD = rf"[^{_W}{_QUOTED}](?:[^{_W}]*[^{_W}{_QUOTED}])?"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _every_span() -> Column:
    """All spans of a row in the order of their starts: s, e, kind, v."""

    def of(kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["v"].alias("v")))

    return F.array_sort(F.concat(*[of(k) for k in KINDS]))


def _rebuilt(text: Column, every: Column, put) -> Column:
    """The text with ``put(span, where the text before it ends)`` in place of each span; spans inside others leave no trace."""

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        inside = x["e"] <= acc["at"]
        out = F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.array(gap, put(x, acc["at"]))))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    end = lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(every, start, step, end)


def _contexts(text: Column, every: Column) -> Column:
    """Kind, value and patterns of each span; the words lie between it and the spans next to it."""

    def sides(x: Column, i: Column) -> Column:
        before, after = F.get(every, i - 1)["e"], F.get(every, i + 1)["s"]
        start = F.when(i > 0, before).otherwise(F.lit(0))
        left = _words(F.substring(text, start + 1, F.greatest(x["s"] - start, F.lit(0))))
        right = _words(F.substring(text, x["e"] + 1, F.greatest(F.coalesce(after, F.length(text)) - x["e"], F.lit(0))))
        return F.struct(x["kind"].alias("kind"), x["v"].alias("v"), left.alias("left"), right.alias("right"))

    def context(x: Column) -> Column:
        one, two, next_ = F.get(x["left"], F.size(x["left"]) - 1), F.get(x["left"], F.size(x["left"]) - 2), F.get(x["right"], F.lit(0))
        rest = F.concat_ws(" ", F.coalesce(two, F.lit("")), F.coalesce(next_, F.lit("")))
        named = [("L ", one, rest), ("R ", next_, F.coalesce(one, F.lit(""))), ("B ", F.concat(one, F.lit(" "), next_), F.lit("")), ("T ", F.concat(two, F.lit(" "), one), F.lit(""))]
        patterns = F.array(*[F.when(words.isNotNull(), F.struct(F.concat(F.lit(name), words).alias("p"), around.alias("around"))) for name, words, around in named])
        return F.struct(x["kind"].alias("kind"), x["v"].alias("v"), F.array_compact(patterns).alias("patterns"))

    # in two steps: what a function is given is evaluated once, what it names is evaluated wherever it stands
    return F.transform(F.transform(every, sides), context)


def _with_filled(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) with the base spans per kind, all of them, and ``filled``: as many fillers in place of each seed."""
    rows = rows.withColumns({k: spans(F.col("text"), k) for k in KINDS}).withColumn("every", _every_span())
    fill = lambda x, at: F.repeat(F.lit(_FILLER), x["e"] - F.greatest(x["s"], at))
    return rows.withColumn("filled", F.when(F.size("every") > 0, _rebuilt(F.col("text"), F.col("every"), fill)).otherwise(F.col("text")))


def found_spans(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, th (hash of the text), the base spans per kind, ``seen``: the seeds with their patterns, and
    ``line``: the words of the filled text in lower case with one blank between, ``n`` of them."""
    rows = _with_filled(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")))
    words = _words(F.col("filled"))  # named twice in one projection, cut once, and never a column of its own
    seen = _contexts(F.col("text"), F.col("every")).alias("seen")
    return rows.select("doc_id", F.xxhash64("text").alias("th"), *KINDS, seen, F.concat_ws(" ", words).alias("line"), F.size(words).alias("n"))


def _same() -> Column:
    """That a row (doc_id, th) is the one that d and t name."""
    return F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))


def _met(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (its words, ``word``, are distinct) with each place of the word: ``doc_id``, ``th``, the words of the
    text and ``i``, where it is in them.

    One pass over the lines, however many words are wanted, up to ``AT_ONCE``. Words meet by their hash, a number, which is looked up
    in a fraction of the time a text takes; then they must be the same (two comparisons, so that it is no key of the join).
    """
    held = cut(wanted.withColumnRenamed("word", "wanted").withColumn("h", F.xxhash64("wanted")), "wanted")
    passes = -(-held.count() // AT_ONCE)
    words = found.select("doc_id", "th", F.split("line", " ").alias("words"))
    every = words.select("*", F.posexplode_outer("words").alias("i", "word")).withColumn("h", F.xxhash64("word"))
    same = (F.col("word") >= F.col("wanted")) & (F.col("word") <= F.col("wanted"))
    some = [held.where(F.pmod("h", F.lit(passes)) == k) if passes > 1 else held for k in range(max(passes, 1))]
    return reduce(DataFrame.unionAll, [every.join(F.broadcast(part), "h").where(same).drop("h", "wanted") for part in some])


def seed_patterns(found: DataFrame) -> DataFrame:
    """pattern, k, s (its seeds of kind k), o (its seeds of other kinds), off (which of its words is the rarest) of the patterns
    that are kept."""
    seen = found.select(F.explode("seen").alias("i")).select(F.col("i.kind").alias("k"), F.col("i.v").alias("value"), F.explode("i.patterns").alias("x"))
    seen = cut(seen.select("k", "value", F.col("x.p").alias("pattern"), F.col("x.around").alias("around")), "seeds")
    per_value = seen.groupBy("pattern", "k", "value").agg(F.count("*").alias("n")).groupBy("pattern", "k").agg(F.count("*").alias("s"), F.sum("n").alias("places"))
    surroundings = seen.groupBy("pattern", "k", "around").count().groupBy("pattern", "k").agg(F.count("*").alias("ways"))
    per_kind = cut(per_value.join(surroundings, ["pattern", "k"]), "patterns")
    enough = F.when(F.substring("pattern", 1, 2).isin("L ", "R "), F.least("s", "ways")).otherwise(F.col("s"))
    per_kind = per_kind.withColumn("enough", enough >= SUPPORT)
    whole = per_kind.groupBy("pattern").agg(F.sum("s").alias("all"), F.sum("places").alias("seeded"), F.max("enough").alias("any"))
    strong = cut(whole.where("any"), "strong")
    if strong.isEmpty():
        return per_kind.select("pattern", "k", "s", F.lit(0).cast("bigint").alias("o"), F.lit(0).alias("off")).where(F.lit(False))
    # how often the words of the patterns are there at all
    named = strong.withColumn("of", F.split(F.expr("substring(pattern, 3)"), " "))
    asked = named.select(F.explode("of").alias("word")).distinct()
    total = found.agg(F.sum("n")).first()[0] or 0
    counts = small_table(_met(found, asked).groupBy("word").agg(F.count("*").alias("places")), "counts")
    each = named.select("pattern", "all", "seeded", F.size("of").alias("n"), F.posexplode("of").alias("off", "word")).join(counts, "word", "left")
    chance = F.exp(F.sum(F.log(F.coalesce("places", F.lit(1)) / F.lit(float(max(total, 1))))))
    expected = F.when(F.col("pattern").startswith("B "), FEW).otherwise(1) * F.col("chance") * float(max(total, 1))
    rarest = F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "off", "word"))["off"].alias("off")
    kept = each.groupBy("pattern", "all", "seeded").agg(chance.alias("chance"), rarest).where(F.col("seeded") >= FLOOR * expected).select("pattern", "all", "off")
    both = per_kind.where("enough").join(kept, "pattern")
    return cut(both.select("pattern", "k", "s", (F.col("all") - F.col("s")).alias("o"), "off"), "kept")


def slots(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern, value, n: at how many places an unknown instance stands in the slot of one of the patterns.

    ``patterns`` has pattern and off. A place is met by that word of the pattern, the words near by then tell the patterns that may
    be there.
    """
    named = cut(patterns.select("pattern", F.concat(F.substring("pattern", 1, 1), "off").alias("by")).distinct(), "named")
    word = F.get(F.split(F.expr("substring(pattern, 3)"), " "), F.substring("by", 2, 1).cast("int"))
    met = _met(found, named.select("by", word.alias("word")).groupBy("word").agg(F.collect_set("by").alias("ways")))
    first = F.greatest(F.col("i") - FEW - 1, F.lit(0))
    met = met.select("ways", F.slice("words", first + 1, F.col("i") - first + FEW + 2).alias("words"), (F.col("i") - first).alias("i"))
    words, i = F.col("words"), F.col("i")
    word = lambda i: F.get(words, i)
    free = lambda w: w.isNotNull() & ~w.contains(_FILLER)
    number = lambda i: F.coalesce(word(i).rlike("^[0-9][0-9()/.+-]*$"), F.lit(False))

    def run(i: Column, step: int) -> Column:
        """How many words an instance has that starts (or, with step -1, ends) at i."""
        out = F.lit(FEW)
        for k in range(FEW - 1, 0, -1):
            out = F.when(~number(i + step * k), F.lit(k)).otherwise(out)
        return F.when(number(i), out).otherwise(F.lit(1))

    def joined(i: Column, m: Column) -> Column:
        return F.concat_ws(" ", F.slice(words, i + 1, m))

    def hit(by: str, name: list[Column], value: Column) -> Column:
        return F.struct(F.lit(by).alias("by"), F.concat_ws(" ", F.lit(by[0]), *name).alias("pattern"), value.alias("value"))

    none = F.array().cast("array<struct<by:string,pattern:string,value:string>>")

    def one(by: str, test: Column, name: list[Column], value: Column) -> Column:
        return F.when(F.array_contains("ways", by) & test, F.array(hit(by, name, value))).otherwise(none)

    def between(by: str, begin, end) -> Column:
        """For each number of words between the words at ``begin`` and ``end``, if there are such."""
        lengths = F.when(F.array_contains("ways", by), F.sequence(F.lit(1), F.lit(FEW))).otherwise(F.array().cast("array<int>"))
        fits = F.filter(lengths, lambda m: word(begin(m)).isNotNull() & word(end(m)).isNotNull() & ~joined(begin(m) + 1, m).contains(_FILLER))
        return F.transform(fits, lambda m: hit(by, [word(begin(m)), word(end(m))], joined(begin(m) + 1, m)))

    after = lambda i: joined(i, run(i, 1))
    before = joined(i - run(i - 1, -1), run(i - 1, -1))
    hits = F.concat(
        one("L0", free(word(i + 1)), [word(i)], after(i + 1)),
        one("R0", free(word(i - 1)), [word(i)], before),
        one("T0", free(word(i + 2)), [word(i), word(i + 1)], after(i + 2)),
        one("T1", word(i - 1).isNotNull() & free(word(i + 1)), [word(i - 1), word(i)], after(i + 1)),
        between("B0", lambda m: i, lambda m: i + m + 1),
        between("B1", lambda m: i - m - 1, lambda m: i),
    )
    every = met.select(F.explode(hits).alias("h")).select("h.*").join(small_table(named, "names"), ["by", "pattern"])
    return every.groupBy("pattern", "value").agg(F.count("*").alias("n"))


def bootstrapped(patterns: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """value, kind, score of the unknown values that are accepted.

    ``patterns`` has pattern, k, s and o, ``edges`` the distinct pairs of pattern and unknown value.
    """
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("u"))
    base = cut(patterns.join(sizes, "pattern"), "base")
    weight = F.col("s") + F.col("o") + ALPHA * F.col("u")
    trust = base.select("pattern", "k", "s", weight.alias("weight"), F.least(F.col("s") / weight, F.lit(0.99)).alias("trust"))
    for turn in range(rounds):
        each = edges.join(trust, "pattern").withColumn("miss", F.log(1 - F.col("trust")))
        scores = cut(each.groupBy("value", "k").agg(F.sum("miss").alias("miss")), "scores")
        if turn == rounds - 1 or scores.isEmpty():
            break
        # what all other patterns of a value say of it
        others = each.join(scores.withColumnRenamed("miss", "whole"), ["value", "k"]).withColumn("score", 1 - F.exp(F.col("whole") - F.col("miss")))
        known = (F.first("s") + ALPHA * F.sum("score")) / F.first("weight")
        more = others.groupBy("pattern", "k").agg(F.first("s").alias("s"), F.first("weight").alias("weight"), F.least(known, F.lit(0.99)).alias("trust"))
        trust = cut(more, "trust")
    best = scores.select("value", "k", (1 - F.exp("miss")).alias("score")).where(F.col("score") >= ACCEPT)
    return best.groupBy("value").agg(F.max(F.struct("score", "k")).alias("m")).select("value", F.col("m.k").alias("kind"), F.col("m.score").alias("score"))


def places(found: DataFrame, values: DataFrame) -> DataFrame:
    """doc_id, th, value, i, m of every place of the values: the first of its words and how many there are.

    ``values`` has value, words with one blank between, and off: a place is met by that word of the value.
    """
    held = small_table(values.select("value", "off"), "held")
    of = F.split("value", " ")
    ways = held.select(F.get(of, F.col("off")).alias("word"), F.struct("off", F.size(of).alias("m")).alias("way"))
    met = _met(found, ways.groupBy("word").agg(F.collect_set("way").alias("ways"), F.max("way.m").alias("most")))
    first = F.greatest(F.col("i") - F.col("most") + 1, F.lit(0))
    near = F.slice("words", first + 1, F.col("i") - first + F.col("most")).alias("words")
    met = met.select("doc_id", "th", "i", "ways", near, (F.col("i") - first).alias("at"))
    there = F.filter("ways", lambda w: (F.col("at") >= w["off"]) & (F.col("at") - w["off"] + w["m"] <= F.size("words")))
    value = lambda w: F.concat_ws(" ", F.slice("words", F.col("at") - w["off"] + 1, w["m"]))
    each = F.transform(there, lambda w: F.struct(value(w).alias("value"), (F.col("i") - w["off"]).alias("i"), w["m"].alias("m"), w["off"].alias("off")))
    return met.select("doc_id", "th", F.explode(each).alias("h")).select("doc_id", "th", "h.*").join(held, ["value", "off"]).drop("off")


def uncommon(found: DataFrame, values: DataFrame, edges: DataFrame) -> DataFrame:
    """value, kind and off (which of its words is the rarest) of the values that occur at most ``COMMON`` times as often as in a slot.

    Words are counted first: a value of one word is settled then, and others are looked for by their rarest word.
    """
    inside = edges.groupBy("value").agg(F.max("n").alias("inside"))
    values = cut(values.join(inside, "value").withColumn("of", F.split("value", " ")), "inside")
    counts = _met(found, values.select(F.explode("of").alias("word")).distinct()).groupBy("word").agg(F.count("*").alias("places"))
    each = values.select("value", "kind", "inside", F.size("of").alias("m"), F.posexplode("of").alias("off", "word")).join(small_table(counts, "counts"), "word")
    rarest = each.groupBy("value", "kind", "inside", "m").agg(F.min(F.struct("places", "off")).alias("rarest"))
    rarest = cut(rarest.select("value", "kind", "inside", "m", "rarest.*"), "rarest")
    rare = F.col("all") <= COMMON * F.col("inside")
    own = rarest.where("m = 1").withColumn("all", F.col("places")).where(rare).select("value", "kind", "off")
    longer = rarest.where("m > 1")
    if longer.isEmpty():
        return cut(own, "own")
    often = places(found, longer).groupBy("value").agg(F.count("*").alias("all"))
    return cut(own.unionAll(longer.join(often, "value").where(rare).select("value", "kind", "off")), "own")


def located(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """d, t and ``sorted``: start, minus the end, kind and end of the places in the rows of ``docs`` that have some.

    ``hits`` has doc_id, th, kind, i and m. Words are counted on from place to place. Few places are broadcast.
    """
    sets = hits.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t")).agg(F.array_sort(F.collect_set(F.struct("i", "m", "kind"))).alias("hits"))
    sets = cut(sets, "sets")
    if (sets.agg(F.sum(F.size("hits"))).first()[0] or 0) <= SMALL_TABLE:
        sets = F.broadcast(sets)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    rows = _with_filled(rows.join(sets, _same()).select("d", "t", "text", "hits"))
    # lower case may change lengths, so these are of the text as it is
    lengths = lambda x: F.transform(x, F.length)
    rows = rows.withColumns({"own": lengths(F.regexp_extract_all("filled", F.lit(_WORD), F.lit(0))), "gap": lengths(F.split("filled", _WORD, -1))})
    rows = rows.withColumn("both", F.zip_with("gap", "own", lambda g, w: g + F.coalesce(w, F.lit(0))))
    total = lambda x, at, n: F.aggregate(F.slice(x, at + 1, n), F.lit(0), lambda a, y: a + y)
    kind = "array<struct<s:int,less:int,kind:string,e:int>>"

    def step(acc: Column, h: Column) -> Column:
        at = acc["at"] + total("both", acc["i"], h["i"] - acc["i"])
        s, e = at + F.get("gap", h["i"]), at + total("both", h["i"], h["m"])
        span = F.struct(s.alias("s"), (-e).alias("less"), h["kind"].alias("kind"), e.alias("e"))
        return F.struct(h["i"].alias("i"), at.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    found = rows.select("d", "t", F.array_sort(F.aggregate("hits", start, step, lambda acc: acc["out"])).alias("sorted"))
    return found.dropDuplicates(["d", "t"])  # of repeated rows


def discovered(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, th and ``more``: the spans of accepted values in that text."""
    none = found.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), F.array().cast("array<struct<kind:string,s:int,e:int>>").alias("more")).where(F.lit(False))
    patterns = seed_patterns(found)
    if patterns.isEmpty():
        return none
    edges = cut(slots(found, patterns), "edges")
    values = cut(bootstrapped(patterns, edges.select("pattern", "value")), "values")
    if values.isEmpty():
        return none
    own = uncommon(found, values, edges)
    if own.isEmpty():
        return none
    sets = located(docs, places(found, own).join(small_table(own.select("value", "kind"), "kinds"), "value"))

    def step(acc: Column, x: Column) -> Column:
        """Spans by start, the longest first: one that ends no later than one before lies inside it."""
        inside = x["e"] <= acc["at"]
        own = F.array(F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], own)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,s:int,e:int>>").alias("out"))
    return sets.select("d", "t", F.aggregate("sorted", start, step, lambda acc: acc["out"]).alias("more"))


def _with_more(rows: DataFrame, more: DataFrame) -> DataFrame:
    return rows.join(more, _same(), "left").drop("d", "t")


def _of(kind: str) -> Column:
    own = F.transform(kind, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    added = F.transform(F.filter(F.coalesce("more", F.array().cast("array<struct<kind:string,s:int,e:int>>")), lambda x: x["kind"] == kind), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    return F.array_sort(F.concat(own, added))


def _joined(kind: str, array: Column) -> Column:
    return F.transform(array, lambda x: F.concat_ws(":", F.lit(kind), x["s"], x["e"]))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans, base_sha256, and ``spans``: base spans and discovered ones."""
    found = cut(found_spans(docs), "spans")
    rows = _with_more(found, discovered(docs, found))
    base = F.concat_ws(",", *[_joined(k, F.col(k)) for k in KINDS])
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", *[_joined(k, _of(k)) for k in KINDS]).alias("spans"),
        F.size(F.coalesce("more", F.array().cast("array<struct<kind:string,s:int,e:int>>"))).cast("long").alias("n_discovered"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns; in the texts every span is replaced by its kind in angle brackets."""
    found = cut(found_spans(docs), "spans")
    more = small_table(discovered(docs, found), "more")
    names = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*names).alias("row"), "doc_id", text.alias("text"), F.xxhash64(text).alias("th"))
    rows = _with_more(rows.withColumns({k: spans(F.col("text"), k) for k in KINDS}), more)
    tagged = lambda k: F.transform(_of(k), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("less"), x["e"].alias("e"), F.lit(f"<{k.upper()}>").alias("tag")))
    rows = rows.withColumn("all", F.array_sort(F.concat(*[tagged(k) for k in KINDS])))
    clean = F.when(F.size("all") > 0, _rebuilt(F.col("text"), F.col("all"), lambda x, at: x["tag"])).otherwise(F.col("row.text"))
    return rows.select(*[clean.alias(n) if n == "text" else F.col(f"row.`{n}`").alias(n) for n in names])
