"""The operators bound to the test tables, next to the SQL they must agree with.

Every query reads its whole tables. Where SQL can't express an operator there is no SQL here;
``tests/llm`` then holds the query against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import aligned_lines, bayes_jaccard, byte_bpe, chunk_prints, collocations, fill_middle, hilbert_shards, host_rules, kneser_ney, license_scan, ordinal_toxicity, spaced_seeds, string_kernel
from forecourt.llm.common import bucket, prepared, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepared(spark), sf_dir)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def crc_table() -> list[int]:
    """What a byte contributes to a CRC-32, for all 256 bytes."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def hilbert_sql(bits: int = 4, shards: int = 8) -> str:
    """The sharding query for tables of up to 10,000 documents, where the quantiles of sizes are exact, too."""
    steps = ", ".join(str(k / (1 << bits)) for k in range(1, 1 << bits))
    ctes = []
    source = "cells"
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for k in range(3):
            high, swap = f"(x{k} >> {q}) & 1 = 1", f"(xor(x0, x{k}) & {low})"
            new = {0: f"case when {high} then xor(x0, {low}) else {f'xor(x0, {swap})' if k else 'x0'} end"}
            if k:
                new[k] = f"case when {high} then x{k} else xor(x{k}, {swap}) end"
            columns = ", ".join(f"{expression} as x{j}" for j, expression in new.items())
            ctes.append(f"s{q}{k} as (select * replace ({columns}) from {source})")
            source = f"s{q}{k}"
    flips = "0"
    for q in range(1, bits):
        flips = f"xor({flips}, ((xor(xor(x0, x1), x2) >> {q}) & 1) * {(1 << q) - 1})"
    gray = ["x0", "xor(x0, x1)", "xor(xor(x0, x1), x2)"]
    index = " + ".join(f"((xor({gray[k]}, f) >> {q}) & 1) * {1 << (3 * q + 2 - k)}" for q in range(bits) for k in range(3))
    table = ", ".join(map(str, crc_table()))
    bound = "len(list_filter({b}, lambda v: v < {k}))"
    cell = ", ".join(f"cast(coalesce({bound.format(b=f'b{k}', k=f'k{k}')}, 0) as bigint) as x{k}" for k in range(3))
    return f"""
with plain as (select doc_id, lang, source, encode(coalesce(text, '')) as bytes from documents),
measured as (select doc_id, octet_length(bytes) + 1 as size,
  xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint),
    list_transform(range(1, octet_length(bytes) + 1), lambda k: cast(('0x' || substr(hex(bytes), 2 * k - 1, 2)) as bigint))),
    lambda crc, byte: xor(crc >> 8, ([{table}])[xor(crc & 255, byte) + 1]))) as text_crc32,
  lang as k0, source as k1, octet_length(bytes) + 1 as k2 from plain),
bounds as (select quantile_disc(k0, [{steps}]) as b0, quantile_disc(k1, [{steps}]) as b1, quantile_disc(k2, [{steps}]) as b2 from measured),
cells as (select doc_id, size, text_crc32, {cell} from measured, bounds),
{", ".join(ctes)},
turned as (select *, {flips} as f from {source}),
indexed as (select doc_id, size, text_crc32, cast({index} as bigint) as hilbert from turned),
placed as (select *, row_number() over (order by hilbert, doc_id nulls first, text_crc32) - 1 as p, count(*) over () as n from indexed),
cut as (select *, ((p + 1) * {shards} - 1) // n as shard from placed)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'rows' as law, cast(shard as integer) as shard,
  cast(p - shard * n // {shards} as bigint) as slot, cast(null as integer) as grown_shard, hilbert from cut"""


@query("op1_hilbert_shards", hilbert_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equally many documents along language, source and size."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = hilbert_shards.hilbert_shards(docs, ["lang", "source", "size"], ["doc_id", "text_crc32"], 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


OP3_SQL = r"""
with docs as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
words as (select r, unnest(w) as word, generate_subscripts(w, 1) as k
  from (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from docs)),
runs as (select r, k, word, lead(word, 1) over o as b, lead(word, 2) over o as c from words window o as (partition by r order by k)),
seen as (select r, k, count(*) over (partition by r, word, b, c) as n from runs where b is not null and c is not null),
covered as (select r, count(distinct p) as n_repeat_words
  from (select r, unnest([k, k + 1, k + 2]) as p from seen where n > 1) group by r),
counted as (select r, count(*) as n_words, sum(length(word)) as word_chars from words group by r),
lines as (select r, sum(n - 1) as n_dup_lines from (
  select r, line, count(*) as n from (select r, unnest(string_split(t, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line) group by r),
stats as (select d.r, doc_id, source, cast(coalesce(n_words, 0) as bigint) as n_words,
  cast(coalesce(word_chars, 0) as bigint) as word_chars,
  cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from docs d left join counted using (r) left join lines using (r) left join covered using (r)),
failing as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from stats),
hosts as (select source, count(*) as n, sum(cast(base_failed as int)) as x from failing group by source),
moments as (select avg(x / n) as m, var_pop(x / n) as v, avg(1.0 / n) as i from hosts),
prior as (select m, greatest(m * (1 - m) / greatest(v - m * (1 - m) * i, m * (1 - m) * 1e-9) - 1, 1e-3) as w from moments),
beta as (select case when m in (0, 1) then 1.0 else m * w end as a, case when m in (0, 1) then 1.0 else (1 - m) * w end as b from prior),
verdict as (select source, (x + a) / (n + a + b) > 0.5 as rejected from hosts, beta)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not rejected as kept
from failing f join verdict v on f.source is not distinct from v.source"""


@query("op3_host_rules", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every text, its own failure, and what its source's shrunk failure rate leaves of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    measured = host_rules.with_measures(docs).drop("text")
    rules = {
        "short": F.col("n_words") < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
    }
    verdicts = host_rules.judged(written(measured), "source", rules)
    return verdicts.select("doc_id", *host_rules.MEASURES, F.col("failed").alias("base_failed"), "kept")


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by public ranks, and the text that the ids decode to, as hashes."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All license notices in the documents."""
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_string_kernel")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", bucket("doc_id", 5) == 0)
    model = string_kernel.learn(docs.filter(~F.col("held_out")), "text", "lang", "doc_id")
    found = string_kernel.identify(docs.drop("lang"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query("op9_ordinal_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether the pipeline rejects it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal_toxicity.learn_from_tables(docs, table(spark, sf_dir, "labels"), "toxic")
    graded = ordinal_toxicity.grade(docs, model)
    return graded.select("doc_id", "severity", "p_toxic", (F.col("p_toxic") > ordinal_toxicity.bound(model)).alias("toxic"))


@query("op8_spaced_seeds")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All overlaps of documents with benchmark items."""
    found = spaced_seeds.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"}).drop("print")


@query("op2_kneser_ney")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", bucket("doc_id", 7) == 2)
    model = kneser_ney.train(docs.filter(~F.col("held_out")))
    return kneser_ney.score(docs, model).drop("perplexity")


OP10_SQL = r"""
with recursive texts as (select row_number() over (order by min(doc_id), text) as t, text, min(doc_id) as rep, count(*) as n_copies
  from documents where text is not null group by text),
words as (select t, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from texts),
shingles as (select distinct t, array_to_string(w[k:k + 4], ' ') as s
  from (select t, w, unnest(range(1, greatest(len(w) - 3, 2))) as k from words where len(w) > 0)),
sizes as (select t, count(*) as n from shingles group by t),
shared as (select a.t as a, b.t as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.t < b.t group by 1, 2),
links as (select a, b from shared s join sizes x on x.t = a join sizes y on y.t = b where 5 * s.n >= 4 * (x.n + y.n - s.n)),
edges as (select a, b from links union all select b, a from links),
reach(t, r) as (select t, t from texts union select e.b, reach.r from reach join edges e on e.a = reach.t),
classes as (select reach.t, min(x.rep) as class_id from reach join texts x on x.t = reach.r group by 1),
degrees as (select a as t, count(*) as n_links from edges group by 1)
select d.doc_id, coalesce(class_id, d.doc_id) as class_id, coalesce(n_links, 0) as n_links, coalesce(n_copies, 1) as n_copies
from documents d left join texts x on x.text = d.text left join classes using (t) left join degrees using (t)"""


@query("op10_bayes_jaccard", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document and the number of its links."""
    found = bayes_jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query("op5_aligned_lines")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All blocks of documents that an earlier document has as well."""
    found = aligned_lines.aligned(table(spark, sf_dir, "documents"))
    doc_id, earlier = (F.when(F.col(c) <= aligned_lines.NO_ID, F.col(c)) for c in ("rank", "first"))
    return found.select(doc_id.alias("doc_id"), earlier.alias("earlier_id"), "start", "end", (F.col("end") - F.col("start")).alias("n_words"))


OP11_SQL = r"""
with docs as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
drawn as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
  [cast('0x' || substr(h, 8 * k - 7, 8) as bigint) for k in range(1, 5)] as d from docs),
cut as (select *, cast(len(u) as bigint) as n, least(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) as a, greatest(d[1] % (len(u) + 1), d[2] % (len(u) + 1)) as b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or d[3] % 100 >= 50 then 'plain'
  when d[4] % 100 < 80 then 'spm' else 'psm' end as form from drawn),
parts as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:n], '') as s from cut)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256 from parts"""


@query("op11_fill_middle", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its middle moved to the end, and the text rebuilt from that."""
    moved = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    back = fill_middle.restore(moved)
    digests = (F.sha2(F.col(c).cast("binary"), 256).alias(f"{name}_sha256") for c, name in (("output", "output"), ("restored", "restored")))
    return back.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", *digests)


OP12_SQL = r"""
with docs as (select row_number() over () as r, coalesce(lang, 'und') as lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as p from docs)),
totals as (select lang, cast(sum(len(w)) as hugeint) as n from pieces group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as k from pieces),
grams as (select lang, size, array_to_string(w[k:k + size - 1], ' ') as phrase
  from (select *, unnest(range(1, 6)) as size from starts) where k + size - 1 <= len(w)),
f as (select lang, size, phrase, count(*) as c from grams group by all having count(*) >= 100),
candidates as (select lang, size, phrase, c, string_split(phrase, ' ') as w from f where size > 1),
cuts as (select lang, size, phrase, c, w, unnest(range(1, size)) as k from candidates),
sides as (select x.lang, x.phrase, x.c, x.k, l.c as l, r.c as r
  from cuts x join f l on l.lang = x.lang and l.phrase = array_to_string(x.w[1:x.k], ' ')
  join f r on r.lang = x.lang and r.phrase = array_to_string(x.w[x.k + 1:x.size], ' ')),
scores as (select s.*, n, 1000 * cast(c as hugeint) * n // (cast(l as hugeint) * r) as score from sides s join totals using (lang)),
weakest as (select *, row_number() over (partition by lang, phrase order by score, k) as place from scores),
covered as (select distinct a.lang, a.phrase from candidates a join candidates b on a.lang = b.lang and a.size < b.size and 100 * b.c >= 100 * a.c
  and contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ')),
ranked as (select w.*, row_number() over (partition by w.lang order by score desc, c desc, w.phrase) as rank
  from weakest w anti join covered o on o.lang = w.lang and o.phrase = w.phrase where place = 1)
select lang, rank, phrase, c as a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from ranked where rank <= 2000"""


@query("op12_collocations", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two thousand phrases of each language whose words belong together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_chunk_prints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and their likeness."""
    return chunk_prints.edit_prints(table(spark, sf_dir, "documents").select("doc_id", "text"))
