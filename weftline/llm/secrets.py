"""Secret scans: three base patterns and a pair of character Markov models.

The base kinds are found by pattern. The method adds tokens that a first-order
Markov chain of random strings explains better than one of ordinary
identifiers; both chains are counted from labelled samples. Everything is
DataFrame functions; positions are code points, ends exclusive.

A text is worked on in chunks of about CHUNK_CHARS that end where no match of
any pattern can go on, so the work grows with the length of a text and not with
its square. Where no such place comes a chunk is as long as it takes.

Defined results: a null or empty text has no spans; spans of one kind never
overlap, spans of different kinds may; an added token never lies within one
base span; an empty table gives no rows; rows are independent, so ties, repeated
rows and further columns don't matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.scratch import fresh

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "random")
_WORDS = ("password", "passwd", "secret", "token", "api_?key")
_EITHER = "|".join("".join(c if c in "_?" else f"[{c}{c.upper()}]" for c in w) for w in _WORDS)
ASSIGN = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"  # a run of 32 or more is the same match as a longest run, filtered
ACCESS_LONG = "AKIA[A-Z0-9]{12,}"  # a shorter run holds no longer match, so nothing else starts
#: Tokens that the models judge: a letter and a digit at least.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Thousandths of a nat per transition above which a token counts as random.
MIN_LLR = 350
#: Code points of a chunk; it ends before a character of no pattern, or before spaces that no assignment spans.
CHUNK_CHARS = 2000
_CUT = r"""(?=[^A-Za-z0-9+/_.=\-"':\x20]|(?<![:=\x20])\x20+[^:=\x20]|\z)"""
CHUNK = rf"(?s).{{1,{CHUNK_CHARS}}}{_CUT}|.+?{_CUT}"
_FRAGMENTS = "get set user name list data file path node index value count total page item order config default version update create delete handler service client server request response session account address message number string array object model table column report status error result system module package import export public private static final main test build release window button image document section content filter search cache queue worker thread process memory buffer stream reader writer parser"
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column, i: Column, block: int = 256) -> Column:
    """Sum of the first i entries of lengths.parts, by whole blocks and then singly."""
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    full = F.floor(i / F.lit(block)).cast("int")
    return add(F.slice(lengths["blocks"], F.lit(1), full)) + add(F.slice(lengths["parts"], full * block + 1, i - full * block))


def located(text: Column, pattern: str) -> Column:
    """The matches of a pattern, leftmost and not overlapping: array of start, hit."""

    def place(found: Column) -> Column:
        n = F.size(found["hits"])
        parts = F.transform(found["hits"], lambda h, i: F.length(h) + F.length(F.element_at(found["gaps"], i + 1)))
        blocks = lambda p: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / F.lit(256)).cast("int")), lambda b: F.aggregate(F.slice(p, b * 256 + 1, F.lit(256)), F.lit(0), lambda a, x: a + x))
        return let(parts, lambda p: let(F.struct(p.alias("parts"), blocks(p).alias("blocks")), lambda s: F.transform(found["hits"], lambda h, i: F.struct((_running(s, i) + F.length(F.element_at(found["gaps"], i + 1))).alias("start"), h.alias("hit")))))

    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(pattern), let(found, place)).otherwise(F.array().cast("array<struct<start:int,hit:string>>"))


def _as_spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["hit"])).alias("end")))


def base_spans(text: Column) -> Column:
    """All spans of the three patterns, by start and then kind."""
    assign = F.filter(located(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 8)
    return F.array_sort(F.concat(_as_spans(assign, 0), _as_spans(located(text, ACCESS_LONG), 1), _as_spans(located(text, HEX), 2)))


def labelled_samples(spark: SparkSession, n: int = 4000) -> DataFrame:
    """Labelled samples: ``sample`` and ``label``, 1 for random strings, 0 for identifiers.

    A fixed number of each, made from digests and from joined name fragments.
    """
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(digest))
    shape = F.col("id") % 4
    made = F.when(shape == 0, b64).when(shape == 1, F.translate(b64, "+/=", "-_")).when(shape == 2, F.upper(F.regexp_replace(b64, "[+/=]", ""))).otherwise(digest)
    random = spark.range(n).select(made.alias("sample"), F.lit(1).alias("label"))
    words = F.split(F.lit(_FRAGMENTS), " ")
    drawn = lambda k, n: (F.conv(F.substring(F.md5(F.concat_ws("-", F.col("id"), F.lit(k))), 1, 8), 16, 10).cast("long") % n).cast("int")
    pick = lambda k: F.element_at(words, drawn(k, F.size(words)) + 1)
    number = drawn(9, F.lit(100000)).cast("string")
    names = [F.concat_ws("_", pick(1), pick(2), pick(3)), F.concat(pick(1), F.initcap(pick(2)), F.initcap(pick(3)), number), F.concat_ws("-", pick(1), pick(2), number), F.concat_ws("/", F.lit(""), pick(1), pick(2), number), F.upper(F.concat_ws("_", pick(1), pick(2), number)), F.concat_ws("=", pick(1), number)]
    kind = drawn(7, F.lit(len(names)))
    ordinary = F.coalesce(*[F.when(kind == k, x) for k, x in enumerate(names)])
    return random.unionByName(spark.range(n).select(ordinary.alias("sample"), F.lit(0).alias("label")))


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratios of all transitions, in thousandths of a nat.

    The counts come back as at most two rows per pair of the fixed alphabet.
    """
    n = len(ALPHABET)
    grams = samples.where(F.length("sample") > 1).select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("sample") - 1), lambda i: F.substring(F.col("sample"), i, F.lit(2)))).alias("gram"))
    counts = [[0.5] * (n * n) for _ in range(2)]
    for label, gram, k in grams.where(F.col("gram").rlike(r"^[A-Za-z0-9+/_=-]{2}$")).groupBy("label", "gram").count().collect():
        counts[int(label)][ALPHABET.index(gram[0]) * n + ALPHABET.index(gram[1])] += k
    logs = [[math.log(c / sum(row)) for row in (per[a * n : a * n + n] for a in range(n)) for c in row] for per in counts]
    return [round(1000 * (r - o)) for o, r in zip(*logs, strict=True)]


def log_ratio(token: Column, ratios: list[int]) -> Column:
    """Summed log-likelihood ratio of a token, in thousandths of a nat."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1))) - 1
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0), lambda a, i: a + F.element_at(table, at(i) * len(ALPHABET) + at(i + 1) + 1))


def model_spans(text: Column, base: Column, ratios: list[int]) -> Column:
    """Tokens that look random and don't lie within one base span."""

    def judged(x: Column) -> Column:
        end = x["start"] + F.length(x["hit"])
        shape = x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]")
        free = ~F.exists(base, lambda b: (b["start"] <= x["start"]) & (b["end"] >= end))
        return shape & free & (log_ratio(x["hit"], ratios) > F.lit(MIN_LLR) * (F.length(x["hit"]) - 1))

    return _as_spans(F.filter(located(text, TOKEN), judged), 3)


def scanned(text: Column, ratios: list[int]) -> Column:
    """The chunks of a text in order, each with its base spans and all spans by places in the chunk."""
    found = lambda c: let(base_spans(c), lambda b: F.struct(c.alias("chunk"), b.alias("base"), F.array_sort(F.concat(b, model_spans(c, b, ratios))).alias("all")))
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK), F.lit(0)), found)


def whole_spans(parts: Column, name: str) -> Column:
    """The spans of all chunks by places in the text."""
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    lengths = F.transform(parts, lambda p: F.length(p["chunk"]))
    blocks = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / F.lit(256)).cast("int")), lambda b: add(F.slice(p, b * 256 + 1, F.lit(256))))
    moved = lambda s, at: F.struct((s["start"] + at).alias("start"), s["kind"].alias("kind"), (s["end"] + at).alias("end"))
    own = lambda sums: F.transform(parts, lambda p, i: F.when(F.size(p[name]) > 0, let(_running(sums, i), lambda at: F.transform(p[name], lambda s: moved(s, at)))).otherwise(F.array().cast(_SPAN)))
    shifted = let(lengths, lambda p: let(F.struct(p.alias("parts"), blocks(p).alias("blocks")), lambda sums: F.flatten(own(sums))))
    return F.when(F.exists(parts, lambda p: F.size(p[name]) > 0), shifted).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, samples: DataFrame | None = None, text: str = "text", base: str = "base_spans", spans: str = "secret_spans") -> DataFrame:
    """docs with two more columns: base spans, and all spans with the models' tokens.

    Columns of docs with these names are replaced; give others to keep them.
    """
    ratios = train(labelled_samples(docs.sparkSession) if samples is None else samples)
    held = fresh("__secrets", *docs.columns, base, spans)
    rows = docs.withColumn(held, scanned(F.col(text), ratios))
    return rows.withColumns({base: whole_spans(F.col(held), "base"), spans: whole_spans(F.col(held), "all")}).drop(held)


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, marker: str = "[SECRET]") -> Column:
    """The text with every run of covered code points replaced by the marker."""
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, a["end"] + 1, s["start"] - a["end"]), F.lit(marker))
        # a span that touches what is covered so far joins its marker
        grown = F.when((s["start"] <= a["end"]) & (F.size(a["parts"]) > 0), a["parts"]).otherwise(F.concat(a["parts"], F.array(piece)))
        return F.struct(F.greatest(a["end"], s["end"]).alias("end"), grown.alias("parts"))

    done = F.aggregate(spans, start, step, lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["end"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """The columns of docs; secrets in text are replaced and n_chars, where present, follows."""
    ratios = train(labelled_samples(docs.sparkSession) if samples is None else samples)
    held = fresh("__secrets", *docs.columns)
    rows = docs.withColumn(held, scanned(F.col("text"), ratios))
    found = F.exists(F.col(held), lambda p: F.size(p["all"]) > 0)
    clean = F.array_join(F.transform(F.col(held), lambda p: redacted(p["chunk"], p["all"])), "")
    new = {"text": F.when(found, clean).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(found, F.length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return rows.withColumns(new).drop(held)


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs).drop("text")
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans"))


def _located_sql(kind: int, pattern: str, keep: str = "TRUE", source: str = "d") -> str:
    """SQL of the places of a pattern's matches: doc_id, kind, start, hit."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {kind} AS kind, (sum(length(gap)) OVER w + coalesce(sum(length(hit)) OVER w, 0) - length(hit))::BIGINT AS start, hit FROM (
      SELECT doc_id, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, unnest(range(len(hits))) AS i FROM (
        SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits FROM {source}))
      WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) QUALIFY {keep}"""


_PICK = "(('0x' || substr(md5(concat_ws('-', id, {k})), 1, 8))::BIGINT % {n})"
_NAMES = "WITH w AS (SELECT string_split('" + _FRAGMENTS + "', ' ') AS words), s AS (SELECT range AS id, sha256('sample-' || range) AS x FROM range(4000)), " + "n AS (SELECT id, " + ", ".join(f"words[1 + {_PICK.format(k=k, n='len(words)')}] AS w{k}" for k in (1, 2, 3)) + f", {_PICK.format(k=9, n=100000)}::VARCHAR AS num, {_PICK.format(k=7, n=6)} AS form FROM s, w), "
OP10_SQL = f"""
{_NAMES}
samples AS (
  SELECT 1 AS label, CASE id % 4 WHEN 0 THEN b WHEN 1 THEN translate(b, '+/=', '-_') WHEN 2 THEN upper(regexp_replace(b, '[+/=]', '', 'g')) ELSE x END AS sample FROM (SELECT *, base64(unhex(x)) AS b FROM s)
  UNION ALL
  SELECT 0, CASE form WHEN 0 THEN concat_ws('_', w1, w2, w3) WHEN 1 THEN concat(w1, upper(w2[1]), w2[2:], upper(w3[1]), w3[2:], num) WHEN 2 THEN concat_ws('-', w1, w2, num)
              WHEN 3 THEN concat_ws('/', '', w1, w2, num) WHEN 4 THEN upper(concat_ws('_', w1, w2, num)) ELSE concat_ws('=', w1, num) END FROM n),
letters AS (SELECT unnest(string_split('{ALPHABET}', '')) AS c),
grams AS (SELECT label, sample[i:i + 1] AS gram, count(*) AS k FROM (SELECT label, sample, unnest(range(1, length(sample))) AS i FROM samples) GROUP BY ALL),
counts AS (SELECT l.label, a.c AS a, b.c AS b, coalesce(g.k, 0) + 0.5::DOUBLE AS k FROM (VALUES (0), (1)) l(label), letters a, letters b LEFT JOIN grams g ON g.label = l.label AND g.gram = a.c || b.c),
logs AS (SELECT label, a || b AS gram, ln(k / sum(k) OVER (PARTITION BY label, a)) AS p FROM counts),
ratios AS (SELECT x.gram, round(1000 * (x.p - y.p))::BIGINT AS r FROM logs x JOIN logs y ON x.gram = y.gram AND x.label = 1 AND y.label = 0),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  {_located_sql(0, ASSIGN, "length(regexp_extract(hit, '" + ASSIGN.replace("'", "''") + "', 2)) >= 8")}
  UNION ALL {_located_sql(1, ACCESS_LONG)}
  UNION ALL {_located_sql(2, HEX)}),
tokens AS (SELECT * FROM ({_located_sql(3, TOKEN)}) k WHERE regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = k.doc_id AND b.start <= k.start AND b.start + length(b.hit) >= k.start + length(k.hit))),
judged AS (SELECT doc_id, kind, start, hit FROM (SELECT *, unnest(range(1, length(hit))) AS i FROM tokens) x JOIN ratios ON gram = hit[i:i + 1] GROUP BY doc_id, kind, start, hit HAVING sum(r) > {MIN_LLR} * (length(hit) - 1)),
spans AS (SELECT doc_id, kind, start, concat_ws(':', ['assign', 'access', 'hex', 'random'][kind + 1], start, start + length(hit)) AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM judged)),
listed AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2, string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base_list, string_agg(span, ',' ORDER BY start, kind) AS all_list FROM spans GROUP BY 1)
SELECT d.doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex, sha256(coalesce(base_list, '')) AS base_sha256, coalesce(all_list, '') AS spans
FROM d LEFT JOIN listed ON listed.doc_id = d.doc_id
"""
