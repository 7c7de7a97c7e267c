"""The registered queries of the text operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import (
    clustering,
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    merkle,
    mixing,
    secret_scan,
    sharding,
    simhash,
    topk,
    toxicity,
    url_filter,
)
from panelcast.llm.common import fold

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_id.train(docs.where(~held_out), "text", "lang", F.col("doc_id"))
    found = language_id.predict_language(docs, model).alias("found")
    return docs.select("doc_id", held_out.alias("held_out"), found).select("doc_id", "held_out", "found.*")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark templates they contain."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and spans of the base scan, spans with those found by entropy."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    order = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(F.lit(["assign", "access", "hex", "entropy"]), s["kind"]).alias("o"), s["kind"].alias("kind"), s["end"].alias("end"))))

    def n(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        n("assign"),
        n("access"),
        n("hex"),
        F.sha2(secret_scan.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text(order).alias("spans"),
        F.size("added").cast("long").alias("n_entropy"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every document."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    spans = F.array_join(
        F.array_sort(F.transform("matches", lambda m: F.concat_ws(":", m["kind"], m["number"].cast("string"), m["license"]))), ","
    )
    return found.select("doc_id", "n_matches", "licenses", "best_license", "best_dice", spans.alias("parts"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    score = toxicity.toxicity_score(model, F.col("text")).alias("score")
    return docs.select("doc_id", held_out.alias("held_out"), score).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rule_table(spark, RULES))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies"
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, balanced by bytes."""
    found = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens"
    )


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document, and whether it still verifies after some have been changed."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(tampered, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    found = merkle.manifest(table(spark, sf_dir, "documents"), fields, "lang", "doc_id", {"n_chars": n_chars})
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds from 40 centroids."""
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("scanned")


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_decontaminate,
        op3_secret_scan,
        op4_license_scan,
        op5_simhash,
        op6_toxicity,
        op7_url_filter,
        op8_mixing,
        op9_exact_dedup,
        op10_sharding,
        op11_topk,
        op12_merkle,
        op13_clustering,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text in SQL: its bytes enter one by one, each followed by eight shifts."""
    steps = f"flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split({text}, '')])"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, {steps}),
        lambda c, b: case when b >= 0 then xor(c, b) when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"""


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(cast({value} as varchar))) || ':' || cast({value} as varchar), '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: Levels of pairs above (tree, size, level, pos, h), until one node is left.
_TREE_SQL = """
    select * from {leaves}
    union all
    select tree, (size + 1) // 2, level + 1, pos // 2, sha256(string_agg(h, '' order by pos))
    from {name} where size > 1 group by tree, size, level, pos // 2"""

_MERKLE_SQL = f"""
    with recursive docs as (
        select doc_id, lang, row_number() over (partition by lang order by doc_id nulls first) - 1 as pos,
               count(*) over (partition by lang) as size, {_leaf_sql("n_chars")} as leaf,
               case when {crc32_sql("cast(doc_id as varchar)")} % 7 = 0 then {_leaf_sql("(n_chars + 1)")} end as other
        from documents),
    numbered as (select lang, row_number() over (order by encode(lang) nulls first) - 1 as tree from (select distinct lang from documents)),
    placed as (select docs.*, tree from docs join numbered on docs.lang is not distinct from numbered.lang),
    leaves as (select tree, size, 0 as level, pos, leaf as h from placed),
    nodes as ({_TREE_SQL.format(leaves="leaves", name="nodes")}),
    tops as (select 0 as tree, (select count(*) from numbered) as size, 0 as level, tree as pos, h from nodes where size = 1),
    upper_nodes as ({_TREE_SQL.format(leaves="tops", name="upper_nodes")}),
    walk as (
        select row_number() over () as id, doc_id, tree, 0 as level, pos, size, coalesce(other, leaf) as folded, '' as proof, leaf from placed
        union all
        select w.id, doc_id, w.tree, w.level + 1, w.pos // 2, (w.size + 1) // 2,
               sha256(case when w.pos % 2 = 1 then s.h || folded else folded || coalesce(s.h, '') end), proof || coalesce(s.h, ''), leaf
        from walk w left join nodes s on s.tree = w.tree and s.level = w.level and s.pos = xor(w.pos, 1)
        where w.size > 1),
    climb as (
        select id, doc_id, leaf, tree, tree as pos, 0 as level, (select count(*) from numbered) as size, folded, proof from walk where size = 1
        union all
        select c.id, doc_id, leaf, c.tree, c.pos // 2, c.level + 1, (c.size + 1) // 2,
               sha256(case when c.pos % 2 = 1 then s.h || folded else folded || coalesce(s.h, '') end), proof || coalesce(s.h, '')
        from climb c left join upper_nodes s on s.level = c.level and s.pos = xor(c.pos, 1)
        where c.size > 1)
    select doc_id, leaf, n.h as subroot, r.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = r.h as verified
    from climb join (select tree, h from nodes where size = 1) n using (tree) cross join (select h from upper_nodes where size = 1) r
    where climb.size = 1"""


def _usable_sql(v: str) -> str:
    return f"{v} is not null and len([x for x in {v} if x is null or not isfinite(x)]) = 0"


def _whole_sql(v: str) -> str:
    return f"[floor(256 * cast(x as double)) for x in {v}]"


_TOPK_SQL = f"""
    with v as (select row_number() over () as n, vec_id, {_whole_sql("embedding")} as e from embeddings where {_usable_sql("embedding")}),
    scored as (
        select q.n, q.vec_id as query_id, p.vec_id, cast(coalesce(list_inner_product(q.e, p.e), 0) as bigint) as score, p.n as other
        from (select * from v where vec_id % 50 = 0) q join v p on len(q.e) = len(p.e) and q.n <> p.n),
    ranked as (
        select query_id, vec_id, score,
               cast(row_number() over (partition by n order by score desc, vec_id nulls last, other) as integer) as rank from scored)
    select query_id, rank, vec_id, score from ranked where rank <= 5"""


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    def nearest(centroids: str) -> str:
        square = "list_inner_product({0}, {0})"
        return f"""select n, arg_min(cluster, d * 4096 + cluster) as cluster, min(d) as d
            from (select v.n, c.cluster, {square.format("v.e")} - 2 * list_inner_product(v.e, c.e) + {square.format("c.e")} as d
                  from v cross join {centroids} c) group by n"""

    parts = [
        f"v as (select row_number() over () as n, vec_id, {_whole_sql('embedding')} as e from embeddings"
        f" where {_usable_sql('embedding')} and len(embedding) = 64)",
        f"""c0 as (select cast(row_number() over (order by h nulls last, e) - 1 as integer) as cluster, e
             from (select *, sha256('2:' || vec_id) as h from v order by h nulls last, e limit {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} as ({nearest(f'c{r}')})")
        if r < rounds:
            parts.append(
                f"""m{r} as (select cluster, list(m order by i) as e from (
                    select cluster, i, floor(sum(x) / count(*)) as m
                    from (select cluster, unnest(e) as x, generate_subscripts(e, 1) as i from a{r} join v using (n)) group by 1, 2) group by 1)"""
            )
            parts.append(f"c{r + 1} as (select cluster, coalesce(m{r}.e, c{r}.e) as e from c{r} left join m{r} using (cluster))")
    return f"""with {", ".join(parts)}
        select vec_id, cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by cluster) as bigint) as cluster_inertia,
               cast(sum(d) over () as bigint) as inertia,
               sha256(array_to_string([cast(x as bigint) for x in c{rounds}.e], ',')) as centroid_sha256
        from a{rounds} join v using (n) join c{rounds} using (cluster)"""


ORACLES = {
    "op7_url_filter": r"""
        with parts as (
            select page_id,
                   case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
            from pages),
        urls as (
            select row_number() over () as n, page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
            from parts),
        rules(verdict, rule_host, rule_path) as (
            values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                   ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        fits as (
            select n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
                   arg_max(verdict, length(rule_host || rule_path)) as verdict
            from urls join rules
              on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
            group by n)
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from urls left join fits using (n)
    """,
    "op9_exact_dedup": f"""
        with texts as (select doc_id, sha256({_LOWER}) as text_sha256 from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, text_sha256
        from texts window same as (partition by text_sha256)
    """,
    "op11_topk": _TOPK_SQL,
    "op12_merkle": _MERKLE_SQL,
    "op13_clustering": _clustering_sql(),
}
