"""One query for each operator over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    bpe,
    chat_format,
    decontaminate,
    language_id,
    license_scan,
    lm_scoring,
    minhash_dedup,
    periodic_runs,
    quality_rules,
    tokens,
    toxicity,
    url_filter,
    vector_codes,
)
from .staging import Workspace
from .texts import slices

TOXIC = 0.3
RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
# A conversation in which both sides say control strings.
HOSTILE = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary that is installed beside Python, on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    """What the checksum of the id leaves; n, which is no remainder, without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n, F.lit(n))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: set size, component and whether it is kept."""
    found = minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of all documents, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, _remainder(10) == 0, tokenizer_path("byte_bpe_50k.tiktoken"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line and paragraph of a document that is a licence notice."""
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "unit", "unit_no", "license", "dice")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text."""
    columns = ["conv_id", "turn", "role", "text"]
    turns = _table(spark, sf_dir, "conversations").select(*columns)
    hostile = spark.createDataFrame(
        [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)], "conv_id bigint, turn bigint, role string, text string"
    )
    return chat_format.digests(chat_format.format_turns(turns.unionByName(hostile)))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labelled rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    learned = docs.filter("doc_id is not null").filter(_remainder(4) != 2)
    model = toxicity.fit(learned, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (_remainder(4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).alias("predicted"),
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of all documents."""
    coded = bpe.encode_decode(_table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with edits and place."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    filters = language_id.fit(docs.filter("doc_id is not null").filter(_remainder(5) != 0))
    return language_id.predict(docs, filters).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score"
    )


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten repeats some of its words periodically up to its end.

    With h the checksum of the id and g = h // 10, texts with h % 10 = 0 have each
    word i from a = g % n on replaced by word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = tokens.words(part.column("text"))
                start, n = words.firsts[:-1], np.diff(words.firsts)
                g = part.column("g").to_numpy(zero_copy_only=False)
                a = g % np.maximum(n, 1)
                p = 1 + (n - a) // (3 + g % 8)
                own = words.text
                i = np.arange(len(own)) - start[own]
                source = start[own] + np.where(i < a[own], i, a[own] + (i - a[own]) % p[own])
                text = tokens.joined(words.values.take(pa.array(source)), words.firsts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), text], ["doc_id", "text"])

    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    planted = docs.filter(chosen).select("doc_id", "text", F.floor(h / 10).alias("g"))
    return docs.filter(~chosen).select("doc_id", "text").unionByName(planted.mapInArrow(run, "doc_id bigint, text string"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of all documents: the longest, and digests of all and of the rest."""
    found = periodic_runs.periodic_runs(_planted(_table(spark, sf_dir, "documents")))
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.s").alias("start"),
        (-F.col("longest.n")).alias("length"),
        F.col("longest.p").alias("period"),
        F.expr("(-1000 * longest.n) div longest.p").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents, and whether they are too short or repeat themselves."""
    found = quality_rules.measures(_table(spark, sf_dir, "documents"))
    failed = quality_rules.base_failed()
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~quality_rules.repetitive()).alias("kept"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors, with the codebooks' digest."""
    rows = vector_codes.usable(_table(spark, sf_dir, "embeddings"))
    books = vector_codes.train(rows)
    schema = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    if books is None:
        return spark.createDataFrame([], schema)
    work = Workspace(spark, "vector-codes")
    coded = work.write(vector_codes.encode(rows, books), "coded")
    return vector_codes.label_errors(coded).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_lm_scoring,
        op3_license_scan,
        op4_chat_format,
        op5_url_filter,
        op6_toxicity,
        op7_ann,
        op8_bpe,
        op9_decontamination,
        op10_language_id,
        op11_periodic_runs,
        op12_quality_rules,
        op13_vector_codes,
    )
}

_CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role as r, text as t
    from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), written as (
    select *, case when role = 'assistant' then 7 else 13 end + 1
        + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
            '([\[<])(\\*)(/?INST\]|/?s>)', '\1\2\\\3', 'g'))
        + length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?s>)', '\1\2\\\3', 'g')) as chars
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r nulls first, t nulls first)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, t nulls first) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(chars) as bigint) as formatted_chars
from written group by conv_id
"""


def _url_oracle() -> str:
    """Trust, rank and distrust of all hosts, round by round."""
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = sorted(RULES, key=lambda r: -len(r.name))
    fits = [f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in rules]
    case = {
        c: "case " + " ".join(f"when {f} then '{getattr(r, c)}'" for f, r in zip(fits, rules, strict=True)) + " end"
        for c in ("name", "verdict")
    }
    link = url_filter.LINK.replace("'", "''")
    parts = [
        f"""rest as (select page_id, html, case when instr(url, '://') > 0
            then substr(url, instr(url, '://') + 3) else '' end as r from pages)""",
        f"""parts as (select page_id, html, {low.format("regexp_extract(r, '^[^/?#]*')")} as host,
            regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from rest)""",
        f"judged as (select page_id, host, path, {case['name']} as rule, {case['verdict']} as said from parts)",
        f"""linked as (select distinct host as src, {low.format('dst')} as dst from (
            select host, unnest(regexp_extract_all(html, '{link}', 1)) as dst from parts where host <> ''))""",
        "edges as (select * from linked where src <> dst)",
        """hosts as (select host, max(a) as allowed, max(b) as blocked from (
            select host, avg(case when said = 'allow' then 1.0 else 0.0 end) as a,
                avg(case when said = 'block' then 1.0 else 0.0 end) as b from judged where host <> '' group by host
            union all select dst, cast(0 as double), cast(0 as double) from edges) group by host)""",
    ]
    d = url_filter.DAMPING

    def walked(seed: str, part: str) -> str:
        return f"""case when n is null then {seed} + {d} / (1 - {d}) * coalesce({part}, 0)
            else (1 - {d}) * {seed} + {d} * coalesce({part}, 0) end"""

    walk = f"""walk as (
        select 0 as k, h.host, h.allowed, h.blocked, o.n, h.allowed as trust, cast(1 as double) as rank, h.blocked as distrust
        from hosts h left join (select src as host, count(*) as n from edges group by src) o using (host)
        union all
        select w.k + 1, w.host, w.allowed, w.blocked, w.n, {walked("w.allowed", "i.trust")}, {walked("1", "i.rank")},
            w.blocked + (1 - w.blocked) * {d} * coalesce(j.distrust, 0) / coalesce(w.n, 1)
        from walk w
        left join (select e.dst as host, sum(m.trust / m.n) as trust, sum(m.rank / m.n) as rank
            from walk m join edges e on e.src = m.host group by e.dst) i on i.host = w.host
        left join (select e.src as host, sum(m.distrust) as distrust
            from walk m join edges e on e.dst = m.host group by e.src) j on j.host = w.host
        where w.k < {url_filter.ROUNDS})"""
    least = url_filter.DISTRUST
    return f"""with recursive {", ".join([*parts, walk])},
verdicts as (select host, case when (distrust >= {least} and distrust >= {d} * trust / rank and distrust > allowed)
    or (blocked >= {least} and blocked > allowed) then 'block' else 'allow' end as verdict
    from walk where k = {url_filter.ROUNDS})
select j.page_id, j.host, j.path, j.rule, coalesce(j.said, v.verdict, 'allow') as verdict
from judged j left join verdicts v using (host)"""


def _quality_oracle() -> str:
    """Windows as lists of words, counted per document."""
    lengths = sorted({quality_rules.WINDOW, *quality_rules.NGRAM_LIMITS})
    parts = [
        r"""w0 as materialized (select row_number() over () as r, doc_id, coalesce(text, '') as t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents)""",
        "w as materialized (select r, unnest(w) as word, unnest(range(len(w))) as i from w0)",
        """base as (select r, doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols from w0)""",
        """l0 as (select r, unnest(string_split(t, chr(10))) as line from w0)""",
        r"""l as (select r, sum(n - 1) as n_dup_lines, sum((n - 1) * length(line)) as dup_line_chars from (
            select r, line, count(*) as n from l0 where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line) group by r)""",
    ]
    sums = []
    for n in lengths:
        parts.append(
            f"""g{n} as (select r, i, count(*) over (partition by r, g) as n,
            row_number() over (partition by r, g order by i) as k from (
                select r, unnest(range(len(w) - {n - 1})) as i,
                    unnest(list_transform(range(len(w) - {n - 1}), lambda i: list_slice(w, i + 1, i + {n}))) as g
                from w0 where len(w) >= {n}))"""
        )
        for name, which, value in (("repeat", "n > 1", "1"), (f"dup_{n}", "k > 1", "length(word)")):
            if name == "repeat" and n != quality_rules.WINDOW:
                continue
            parts.append(
                f"""{name} as (select r, sum({value}) as {name} from w join (
                    select distinct r, i + unnest(range({n})) as i from g{n} where {which}) using (r, i) group by r)"""
            )
            sums.append(name)
    joins = " ".join(f"left join {s} using (r)" for s in ["l", *sums])
    limits = [f"100 * coalesce(dup_{n}, 0) <= {limit} * word_chars" for n, limit in quality_rules.NGRAM_LIMITS.items()]
    limits.append(f"100 * coalesce(dup_line_chars, 0) <= {quality_rules.LINE_LIMIT} * word_chars")
    failed = f"""(n_words < {quality_rules.LEAST_WORDS}
        or 100 * coalesce(repeat, 0) > {quality_rules.MOST_REPEATED} * n_words)"""
    return f"""with {", ".join(parts)}
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
    cast(n_symbols as bigint) as n_symbols, cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    cast(coalesce(repeat, 0) as bigint) as n_repeat_words, {failed} as base_failed,
    not {failed} and {" and ".join(limits)} as kept
from base {joins}"""


def _codes_oracle() -> str:
    """All rounds written out, a table of distances and one of entries for each."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    steps = [
        f"""kept as materialized (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
            list_transform(embedding, lambda x: cast(floor({vector_codes.SCALE} * cast(x as double)) as bigint)) as v
            from embeddings where embedding is not null
                and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0)""",
        f"""x as materialized (select r, j // (n // {parts}) as p, j % (n // {parts}) as i, x from (
            select r, len(v) as n, unnest(v) as x, unnest(range(len(v))) as j from kept))""",
        f"b0 as materialized (select p, r - 1 as e, i, x as c from x where r <= {entries})",
    ]
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(
            f"""a{k} as materialized (select r, p, e, d from (
                select r, p, e, d, row_number() over (partition by r, p order by d, e) as place from (
                    select r, p, e, sum((x - c) * (x - c)) as d from x join b{k} using (p, i) group by r, p, e))
                where place = 1)"""
        )
        if k < vector_codes.ROUNDS:
            steps.append(
                f"""b{k + 1} as materialized (select p, e, i, coalesce(m, c) as c from b{k} left join (
                    select p, e, i, cast((s - ((s % n) + n) % n) // n as bigint) as m from (
                        select p, e, i, sum(x) as s, count(*) as n from a{k} join x using (r, p) group by p, e, i))
                    using (p, e, i))"""
            )
    last = vector_codes.ROUNDS
    return f"""with {", ".join(steps)},
coded as materialized (select r, string_agg(printf('%02x', e), '' order by p) as code, cast(sum(d) as bigint) as error
    from a{last} group by r)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
    (select sha256(string_agg(cast(c as varchar), ',' order by p, e, i)) from b{last}) as codebooks_sha256
from kept join coded using (r)"""


ORACLES: dict[str, str] = {
    "op12_quality_rules": _quality_oracle(),
    "op13_vector_codes": _codes_oracle(),
    "op3_license_scan": license_scan.oracle_sql(),
    "op4_chat_format": _CHAT,
    "op5_url_filter": _url_oracle(),
}
