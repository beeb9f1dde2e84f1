"""The operators over the given tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import records as rec
from textloom.functions import text as tx
from textloom.functions.words import word_stats
from textloom.operators import authority, inventory, ratings
from textloom.operators import index as idx
from textloom.operators.compound import Remote, compound_index, remote_counts
from textloom.operators.grep import grep
from textloom.operators.language import LanguageModel
from textloom.operators.letter_table import letter_table
from textloom.operators.lists import restrict_documents
from textloom.operators.references import references
from textloom.operators.select import select
from textloom.operators.shrink import shrink_schema
from textloom.operators.summary import summary, summary_display, summary_json
from textloom.operators.vocabulary import vocabulary
from textloom.functions.references import PATTERNS
from textloom.plans import corpus as c
from textloom.session import durable
from textloom.sources.readers import read_table
from textloom.sources.writers import append_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FREQUENT = 20
PATTERN = "(eaux|sch[aeiou]|tion) "
LITERAL = "the"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Doubles to six places, as the order of additions is not fixed."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


# Documents ---------------------------------------------------------------


@query
def doc_hash(spark: SparkSession, sf: str) -> DataFrame:
    digest = tx.sha256(F.col("content"))
    return c.corpus(spark, sf).select(
        "path", digest.alias("sha256"), tx.hash_prefix(digest).alias("hash")
    )


@query
def doc_stats(spark: SparkSession, sf: str) -> DataFrame:
    text = tx.decode(F.col("content"))
    stats = c.corpus(spark, sf).select(
        "path",
        F.octet_length("content").cast("long").alias("size"),
        F.char_length(text).cast("long").alias("chars"),
        word_stats(text).alias("stats"),
    )
    mean = F.when(F.col("stats.words") > 0, F.col("stats.bytes") / F.col("stats.words")).otherwise(0.0)
    found = stats.select(
        "path", "size", "chars", F.col("stats.words").alias("words"), mean.cast("float").alias("avg_word_len")
    )
    return rounded(found, "avg_word_len")


@query
def doc_ratios(spark: SparkSession, sf: str) -> DataFrame:
    text = tx.decode(F.col("content"))
    found = c.corpus(spark, sf).select(
        "path", tx.alpha_ratio(text).alias("alpha"), tx.alphanum_ratio(text).alias("alphanum")
    )
    return rounded(found, "alpha", "alphanum")


@query
def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    path = c.path_of(F.col("doc_id"))
    absolute = F.concat(F.lit("/srv/corpus/"), path)
    return read_table(spark, sf, "documents").select(
        tx.relative_path(absolute, "/srv/corpus").alias("path"),
        tx.document_id(absolute).alias("ppn"),
        tx.doctype(absolute).alias("doctype"),
    )


@query
def lang_code(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", tx.lang_code(F.col("lang")).alias("lang_code"))


@query
def lfreq_distance(spark: SparkSession, sf: str) -> DataFrame:
    found = idx.letter_distances(c.corpus(spark, sf))
    return rounded(found, "dist_ger", "dist_eng")


@query
def lang_detect(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.corpus(spark, sf)
    found = LanguageModel.fit(docs).detect(docs)
    return rounded(found, "lang_score").select("path", "lang_code", "lang_score")


@query
def lang_detect_rare(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a model of which most bigrams are joined."""
    docs = c.corpus(spark, sf)
    found = LanguageModel.fit(docs, common=100).detect(docs)
    return rounded(found, "lang_score").select("path", "lang_code", "lang_score")


@query
def lang_detect_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted on the documents, detected on the turns, which are shorter."""
    model = LanguageModel.fit(c.corpus(spark, sf))
    return rounded(model.detect(c.turns(spark, sf)), "lang_score")


@query
def build_index(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.corpus(spark, sf)
    languages = LanguageModel.fit(docs).detect(docs)
    found = idx.build_index(docs, F.col("remote"), languages)
    return rounded(found, "lang_score", "lfreq", "alpha", "alphanum", "avg_word_len")


@query
def index_shared_paths(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.shared_paths(spark, sf)
    found = idx.build_index(docs, F.col("remote"), LanguageModel.fit(docs).detect(docs))
    return rounded(found, "lang_score").select("remote", "path", "hash", "lang_code", "lang_score", "size")


@query
def shrink_index(spark: SparkSession, sf: str) -> DataFrame:
    narrow = shrink_schema(durable(c.index(spark, sf)))
    return narrow.agg(
        *[F.max(F.typeof(n)).alias(f"{n}_type") for n in ("size", "mtime")],
        *[F.sum(F.col(n).cast("long")).alias(f"{n}_sum") for n in ("size", "mtime")],
    )


@query
def letter_table_query(spark: SparkSession, sf: str) -> DataFrame:
    return letter_table(c.corpus(spark, sf))


QUERIES["letter_table"] = QUERIES.pop("letter_table_query")


# Select ------------------------------------------------------------------


@query
def select_columns(spark: SparkSession, sf: str) -> DataFrame:
    return select(c.index(spark, sf), columns="ppn, upper(doctype) AS kind, size * 8 AS bits")


@query
def select_where(spark: SparkSession, sf: str) -> DataFrame:
    return select(c.index(spark, sf), where="lang_code = 'ger' AND size > 1000")


@query
def select_sql_tail(spark: SparkSession, sf: str) -> DataFrame:
    return select(
        c.index(spark, sf),
        columns="lang_code, doctype, count(*) AS docs, max(size) AS largest",
        where="size > 100 GROUP BY lang_code, doctype HAVING count(*) > 2 ORDER BY docs DESC",
        on="doctype",
    )


@query
def select_subquery(spark: SparkSession, sf: str) -> DataFrame:
    return select(
        c.index(spark, sf), columns="ppn, size", where="size >= (SELECT avg(size) FROM df) AND doctype <> 'toc'"
    )


@query
def select_allow(spark: SparkSession, sf: str) -> DataFrame:
    return select(c.index(spark, sf), columns="ppn, path, size", allow=c.allow_list(spark, sf))


@query
def select_allow_multikey(spark: SparkSession, sf: str) -> DataFrame:
    return select(
        c.index(spark, sf),
        columns="path, hash",
        allow=c.allow_list(spark, sf),
        left_on="ppn, doctype",
        right_on="ppn, kind",
    )


@query
def select_deny(spark: SparkSession, sf: str) -> DataFrame:
    return select(
        c.index(spark, sf), columns="ppn, path", where="doctype <> 'toc'", deny=c.deny_list(spark, sf)
    )


@query
def select_append(spark: SparkSession, sf: str) -> DataFrame:
    index = c.index(spark, sf)
    columns = "remote, ppn, doctype, size"
    return append_rows(
        select(index, columns, "doctype = 'book'"), select(index, columns, "size > 3000")
    )


@query
def snapshot_docs(spark: SparkSession, sf: str) -> DataFrame:
    listed = c.indexed_side(spark, sf)
    docs = c.corpus(spark, sf).withColumn("doctype", tx.doctype(F.col("path")))
    return restrict_documents(docs, listed).select(
        "path", "doctype", tx.sha256(F.col("content")).alias("sha256")
    )


# Grep --------------------------------------------------------------------


@query
def grep_match(spark: SparkSession, sf: str) -> DataFrame:
    return grep(c.entries(c.corpus(spark, sf)), PATTERN)


@query
def grep_invert(spark: SparkSession, sf: str) -> DataFrame:
    return grep(c.entries(c.corpus(spark, sf)), PATTERN, invert=True)


@query
def grep_ignore_case(spark: SparkSession, sf: str) -> DataFrame:
    return grep(c.entries(c.corpus(spark, sf)), "ÉLE[^a-z]", ignore_case=True)


@query
def grep_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return grep(c.entries(c.corpus(spark, sf)), LITERAL, max_bytes=100)


@query
def grep_allow_deny(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.corpus(spark, sf)
    return grep(
        c.entries(docs).drop("content"),
        PATTERN,
        docs,
        allow=c.allow_list(spark, sf),
        deny=c.deny_list(spark, sf),
    )


@query
def grep_relabel(spark: SparkSession, sf: str) -> DataFrame:
    return grep(c.entries(c.corpus(spark, sf)), PATTERN, doctype="ft", comment="seen")


@query
def grep_header(spark: SparkSession, sf: str) -> DataFrame:
    return grep(
        c.entries(c.corpus(spark, sf)),
        PATTERN,
        where="lang_code <> 'eng'",
        header="ppn, lang_code, length(path) AS path_len",
    )


@query
def grep_where_tail(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.corpus(spark, sf)
    return grep(
        c.entries(docs).drop("content"),
        PATTERN,
        docs,
        where="size > (SELECT min(size) FROM df) ORDER BY size DESC, path LIMIT 50",
    )


# Vocabulary --------------------------------------------------------------


@query
def ngram_unigrams(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf))


@query
def ngram_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 2)


@query
def ngram_trigrams(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 3)


@query
def ngram_having(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 2, min_tf=FREQUENT, min_df=FREQUENT // 2)


@query
def ngram_minlen(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 1, min_token_len=8)


@query
def ngram_category(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 2, categories=["u", "t"])


@query
def ngram_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    """Stop words of a table: the words of the benchmark."""
    return vocabulary(c.corpus(spark, sf), 2, stopwords=c.stopwords(spark, sf))


@query
def ngram_stopwords_join(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 3, stopwords=c.stopwords(spark, sf))


@query
def ngram_stopwords_unigrams(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.corpus(spark, sf), 1, stopwords=c.stopwords(spark, sf))


@query
def ngram_shared_paths(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(c.shared_paths(spark, sf), 2, stopwords=c.stopwords(spark, sf))


@query
def ngram_where_tail(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(
        c.corpus(spark, sf), where="lang_code IN (SELECT max(lang_code) FROM df) ORDER BY path LIMIT 40"
    )


@query
def ngram_allow_deny(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(
        c.corpus(spark, sf),
        where="lang_code <> 'spa'",
        allow=c.allow_list(spark, sf),
        deny=c.deny_list(spark, sf),
    )


# References --------------------------------------------------------------


def _references_of(*kinds: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return references(c.identifier_corpus(spark, sf), {k: PATTERNS[k] for k in kinds})

    return run


for _kind in PATTERNS:
    QUERIES[f"refs_{_kind}"] = _references_of(_kind)


@query
def refs_shared_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of both remotes; each document has its own in front."""
    docs = c.shared_paths(spark, sf)
    name = F.concat(F.lit("ISSN 1234-567"), F.length("remote").cast("string"), F.lit(" "), F.col("content").cast("string"))
    return references(docs.withColumn("content", name.cast("binary")), {"issn": PATTERNS["issn"]})


@query
def refs_custom(spark: SparkSession, sf: str) -> DataFrame:
    """A kind of one's own, whose pattern looks around itself."""
    return references(c.corpus(spark, sf).drop("remote"), {"tail": r"(?<=th)(e[a-z])(?= )"})


QUERIES["refs_all"] = _references_of(*PATTERNS)


# Inventory ---------------------------------------------------------------


@query
def inventory_status(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.status(c.indexed_side(spark, sf), c.files_side(spark, sf))


@query
def status_shared_paths(spark: SparkSession, sf: str) -> DataFrame:
    docs = c.shared_paths(spark, sf)
    indexed = c.entries(docs).drop("content").where("remote = 'pages' OR size > 1000")
    return inventory.status(indexed, docs.where("remote = 'documents' OR octet_length(content) > 3000"))


@query
def inventory_missing(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.missing(c.indexed_side(spark, sf), c.files_side(spark, sf))


@query
def inventory_untracked(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.untracked(c.indexed_side(spark, sf), c.files_side(spark, sf))


@query
def inventory_counts(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.counts(c.indexed_side(spark, sf), c.files_side(spark, sf))


@query
def index_prune(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.prune(c.indexed_side(spark, sf), c.files_side(spark, sf))


@query
def verify_permissive(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.violations(c.indexed_side(spark, sf), c.files_side(spark, sf), "permissive")


@query
def verify_strict(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.violations(c.indexed_side(spark, sf), c.files_side(spark, sf), "strict")


@query
def verify_pedantic(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.violations(c.indexed_side(spark, sf), c.files_side(spark, sf), "pedantic")


# Summaries and remotes ---------------------------------------------------


@query
def corpus_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summary(c.index(spark, sf))


@query
def summary_compound(spark: SparkSession, sf: str) -> DataFrame:
    return summary(compound_index(c.remotes(spark, sf)))


@query
def summary_json_query(spark: SparkSession, sf: str) -> DataFrame:
    return summary_json(compound_index(c.remotes(spark, sf)))


@query
def summary_display_query(spark: SparkSession, sf: str) -> DataFrame:
    return summary_display(c.index(spark, sf))


QUERIES["summary_json"] = QUERIES.pop("summary_json_query")
QUERIES["summary_display"] = QUERIES.pop("summary_display_query")


@query
def compound_index_query(spark: SparkSession, sf: str) -> DataFrame:
    return compound_index(c.remotes(spark, sf))


@query
def remote_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    return remote_counts(c.remotes(spark, sf))


@query
def compound_where_tail(spark: SparkSession, sf: str) -> DataFrame:
    """The largest documents of one remote beside the pages above the mean."""
    documents, pages, *_ = c.remotes(spark, sf)
    return compound_index(
        [
            Remote("documents", documents.index, "size > 0 ORDER BY size DESC, path LIMIT 30"),
            Remote("pages", pages.index, "size > (SELECT avg(size) FROM df)"),
        ]
    )


QUERIES["compound_index"] = QUERIES.pop("compound_index_query")
QUERIES["remote_counts"] = QUERIES.pop("remote_counts_query")


# Authorities -------------------------------------------------------------


@query
def authority_links(spark: SparkSession, sf: str) -> DataFrame:
    return authority.link_counts(c.order_links(spark, sf), distinct=False)


@query
def authority_threshold(spark: SparkSession, sf: str) -> DataFrame:
    found = c.part_authorities(spark, sf)
    found = found.select("*", *authority.authority_columns(F.col("ppn"), c.URI_BASE))
    counts = authority.link_counts(c.order_links(spark, sf), distinct=False)
    limits = {"STANDARD": 25, "LARGE": 30, "MEDIUM": 35, "ECONOMY": 40, "PROMO": 0}
    return authority.threshold(found, counts, limits)


@query
def authority_kind(spark: SparkSession, sf: str) -> DataFrame:
    records = c.records(spark, sf)
    code = F.get(rec.subfield_values(F.col("fields"), "002@", ["0"]), F.lit(0))
    return records.where(rec.is_authority(F.col("fields"))).select(
        "record_id", code.alias("code"), rec.authority_kind(code).alias("kind")
    )


@query
def authority_records(spark: SparkSession, sf: str) -> DataFrame:
    """Links out of nested records: every line item, and its supplier if it was returned."""
    returned = authority.LinkRule(
        tag="044K",
        codes=("9",),
        where=lambda f: rec.any_subfield(f, "010@", "a", lambda v: v == "R"),
    )
    links = authority.record_links(c.records(spark, sf), [authority.LinkRule(), returned])
    return authority.link_counts(links)


@query
def authority_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return authority.authority_vocabulary(
        c.records(spark, sf),
        c.URI_BASE,
        thresholds={"corporate-body": 25, "conference": 30, "person": 40},
        order_by="record_id",
    )


@query
def authority_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Records of two editions: the last one counts."""
    return authority.authorities(c.repeated_records(spark, sf), c.URI_BASE, order_by="edition").select("ppn", "kind")


@query
def record_filter(spark: SparkSession, sf: str) -> DataFrame:
    returned = rec.any_subfield(F.col("fields"), "010@", "a", lambda v: v == "R")
    return c.records(spark, sf).where(returned).groupBy("record_id").agg(F.count("*").alias("records"))


@query
def record_similarity(spark: SparkSession, sf: str) -> DataFrame:
    name, wanted = F.col("p_name"), F.lit("Small Plate")
    found = read_table(spark, sf, "part").select(
        "p_partkey",
        rec.similarity(name, wanted, ignore_case=True).alias("similarity"),
        rec.similar(name, wanted, ignore_case=True).alias("alike"),
    )
    return rounded(found, "similarity")


# Ratings -----------------------------------------------------------------


@query
def ratings_admission(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.admit(
        c.rating_events(spark, sf), c.rating_users(spark, sf), c.index(spark, sf).select("path")
    )


@query
def rating_worklist(spark: SparkSession, sf: str) -> DataFrame:
    index = c.index(spark, sf)
    chosen = index.where("lang_code <> 'eng'")
    return ratings.worklist(index, c.rating_log(spark, sf), chosen).select("remote", "path", "hash", "ppn")


@query
def rating_latest(spark: SparkSession, sf: str) -> DataFrame:
    log = c.rating_events(spark, sf).select(
        F.lit("events").alias("remote"),
        "path",
        "hash",
        "rating",
        "comment",
        "username",
        (F.col("event_id") % 7).alias("created_at"),
    )
    return ratings.latest_ratings(log)
