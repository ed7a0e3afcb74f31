"""The corpus operators as queries over whole tables: name -> (spark, sf_dir) -> DataFrame."""

import public_tokenizers

from naviscope.llm import alignment, bpe, chat, collocations, leaks, licenses, main_text, near, pii, quality, secrets, token_file, urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_token_file(spark, sf_dir):
    return token_file.tokens_written_and_read(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op3_chat_format(spark, sf_dir):
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversations_formatted(rows.unionByName(more), VOCABULARY)


@query
def op5_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op1_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op4_url_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"))


@query
def op10_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op6_decontamination(spark, sf_dir):
    found = leaks.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("fingerprint")


@query
def op7_jaccard_join(spark, sf_dir):
    return near.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copy_id")


@query
def op8_pii(spark, sf_dir):
    return pii.scan(table(spark, sf_dir, "documents"))


@query
def op9_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op11_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


# Pieces, words and n-grams by position; arithmetic in 128 bits.
ORACLES["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as doc,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as w from pieces),
totals as (select lang, sum(len(w))::hugeint as n from words group by lang),
starts as (select lang, w, unnest(generate_series(1, len(w))) as i from words where len(w) > 0),
grams as (
  select lang, w[i:i + k - 1] as g from starts, (values (1), (2), (3), (4), (5)) as s(k) where i + k - 1 <= len(w)),
freq as (select lang, g, count(*)::hugeint as f from grams group by lang, g having count(*) >= 100),
candidates as (select lang, g, f, len(g) as k from freq where len(g) > 1),
longer as (
  select distinct lang, sub, f from (
    select lang, f, unnest([g[1:k - 1], g[2:k]]) as sub from candidates where k > 2)),
kept as (select c.* from candidates c anti join longer x on c.lang = x.lang and c.g = x.sub and 100 * x.f >= 100 * c.f),
cuts as (
  select c.lang, c.g, c.f as a, h.f as l, t.f as r, t2.n, j, (1000::hugeint * c.f * t2.n) // (h.f * t.f) as score
  from kept c join (values (1), (2), (3), (4)) as s(j) on j < c.k
  join freq h on h.lang = c.lang and h.g = c.g[1:j]
  join freq t on t.lang = c.lang and t.g = c.g[j + 1:c.k]
  join totals t2 on t2.lang = c.lang),
best as (select *, row_number() over (partition by lang, g order by score, j) as nth from cuts),
ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank,
         array_to_string(g, ' ') as phrase, a, l, r, n, score
  from best where nth = 1)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""


@query
def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"), VOCABULARY, PIECES)
