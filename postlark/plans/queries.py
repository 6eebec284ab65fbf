"""Registered queries: (spark, folder) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.functions import keyvalues, links, text, times
from postlark.functions.stemming import stem
from postlark.operators import cadence as bots
from postlark.operators import classify, dedup, enrich, features, filters, graph
from postlark.operators.aggregators import flag_aggregators
from postlark.operators.documents import retain, retention_cutoff, to_documents, write_back_scores
from postlark.plans import jobs
from postlark.session import scratch_path, stage
from postlark.sources import corpus, keyindex, messages, search, stores, versions
from postlark.sources.tables import history, labelled_documents, load, post_stream, posts
from postlark.streaming import jobs as streams

SURROGATE_LIMITS = bots.Thresholds(fast=36_000, regular=600, spread=20_000_000_000)
SURROGATE_SITES = ("blog.", "m.")
DAY_ELEVEN = "2024-01-11 00:00:00"
RETENTION_NOW = "2024-02-10 00:00:00"
PEOPLE_BATCH = 100

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _joined(items: Column, by: str = "|") -> Column:
    return F.array_join(items, by)


def _at(stamp: str) -> Column:
    return F.lit(stamp).cast("timestamp")


# -- posting rhythm ---------------------------------------------------------------------------


@query
def bot_cadence(spark: SparkSession, folder: str) -> DataFrame:
    return bots.cadence(history(spark, folder))


@query
def bot_cadence_scaled(spark: SparkSession, folder: str) -> DataFrame:
    return bots.cadence(history(spark, folder), limits=SURROGATE_LIMITS)


@query
def bot_cadence_int32(spark: SparkSession, folder: str) -> DataFrame:
    return bots.cadence(history(spark, folder), int32_wrap=True)


@query
def bot_cadence_full_history(spark: SparkSession, folder: str) -> DataFrame:
    return bots.cadence(history(spark, folder), size=None, limits=SURROGATE_LIMITS)


@query
def newest_posts(spark: SparkSession, folder: str) -> DataFrame:
    return bots.newest(history(spark, folder)).select("user_id", "post_id")


@query
def gap_changes(spark: SparkSession, folder: str) -> DataFrame:
    return bots.gap_changes(bots.newest(history(spark, folder))).select("user_id", "post_id", "dt", "dd")


def _people(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select("user_id").distinct()


def _first_scores(spark: SparkSession, folder: str) -> DataFrame:
    nobody = _people(spark, folder).filter(F.lit(False))
    return jobs.check_bots(_people(spark, folder), nobody, history(spark, folder), PEOPLE_BATCH)


def _all_scores(spark: SparkSession, folder: str) -> DataFrame:
    nobody = _people(spark, folder).filter(F.lit(False))
    return jobs.check_bots(_people(spark, folder), nobody, history(spark, folder))


@query
def bot_unscored_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The batch after the first one."""
    done = _first_scores(spark, folder).select("user_id")
    return bots.unscored_batch(_people(spark, folder), done)


@query
def bot_writeback(spark: SparkSession, folder: str) -> DataFrame:
    documents = to_documents(posts(spark, folder))
    return write_back_scores(documents, _all_scores(spark, folder)).select(
        "post_id", F.col("user.id").alias("user_id"), "metadata.*"
    )


@query
def graph_scored_persons(spark: SparkSession, folder: str) -> DataFrame:
    people = graph.persons(_graph_rows(spark, folder))
    return graph.score_persons(people, _all_scores(spark, folder))


# -- filters and text -------------------------------------------------------------------------


@query
def lang_length_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.in_language_and_long(load(spark, folder, "documents"))
    return kept.select("doc_id", text.utf16_length(F.col("text")).cast("bigint").alias("units"))


@query
def keyword_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without keyword stay, as (0.0, null)."""
    flagged = posts(spark, folder).withColumn("matched", filters.has_keyword(F.col("text")))
    return flagged.select(
        "id", "matched",
        filters.score_or_zero(F.lit(1.0), F.col("matched")).alias("score"),
        filters.post_or_null(flagged, F.col("matched"), ["id"])["id"].alias("kept_id"),
    )


@query
def post_texts(spark: SparkSession, folder: str) -> DataFrame:
    return filters.texts(posts(spark, folder))


@query
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


@query
def tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = features.with_tokens(load(spark, folder, "documents"), stemmed=False)
    return docs.select("doc_id", F.size("tokens").cast("bigint").alias("n"), _joined(F.col("tokens")).alias("tokens"))


@query
def stem_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = features.with_tokens(load(spark, folder, "documents"))
    return docs.select("doc_id", _joined(F.col("tokens")).alias("stems"))


@query
def stem_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    docs = features.with_tokens(load(spark, folder, "documents"), stemmed=False)
    distinct = docs.select(F.explode(F.array_distinct("tokens")).alias("word")).distinct()
    return distinct.select("word", stem("word").alias("stem"))


@query
def link_list(spark: SparkSession, folder: str) -> DataFrame:
    """Links of pages and of posts."""
    pages = load(spark, folder, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    both = pages.unionByName(posts(spark, folder).select(F.lit("post").alias("kind"), "id", "text"))
    return both.select("kind", "id", F.posexplode(links.links(F.col("text"))).alias("place", "link")).select(
        "kind", "id", F.col("place").cast("bigint").alias("place"), "link"
    )


@query
def first_link(spark: SparkSession, folder: str) -> DataFrame:
    return posts(spark, folder).select("id", links.first_link(F.col("text")).alias("link"))


@query
def hashtags(spark: SparkSession, folder: str) -> DataFrame:
    return posts(spark, folder).select("id", _joined(links.hashtags(F.col("text"))).alias("tags"))


@query
def list_text(spark: SparkSession, folder: str) -> DataFrame:
    return posts(spark, folder).select("id", text.list_text(links.hashtags(F.col("text"))).alias("tags"))


@query
def contacts_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _contacts(load(spark, folder, "documents"), "doc_id", "text")


@query
def contacts_pages(spark: SparkSession, folder: str) -> DataFrame:
    return _contacts(load(spark, folder, "pages"), "page_id", "html")


def _contacts(table: DataFrame, key: str, column: str) -> DataFrame:
    return enrich.page_contacts(table, column, key).select(
        key,
        _joined(F.sort_array("phone"), ",").alias("phone"),
        _joined(F.sort_array("email"), ",").alias("email"),
    )


@query
def kv_parse(spark: SparkSession, folder: str) -> DataFrame:
    """User profiles as key-value text; those without a place hold a pair without value."""
    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    profile = F.concat(
        F.lit(keyvalues.PROFILE_OPENING), F.lit("id="), F.col("user.id").cast("string"),
        F.lit(", name="), quoted(F.concat("user.name", F.lit(", "), "user.location")),
        F.lit(", screenName="), quoted(F.col("user.screen_name")),
        F.lit(", url="), quoted(F.col("source")),
        F.when(F.col("place").isNull(), ", bad=").otherwise(", location=''"), F.lit("}"),
    )
    parsed = posts(spark, folder).select("id", keyvalues.profile_map(profile).alias("p"))
    return parsed.select(
        "id",
        *[F.col("p")[k].alias(f"p_{k.lower()}") for k in ("id", "name", "screenName", "url", "location")],
    )


@query
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return features.word_count(load(spark, folder, "documents"))


# -- features and classifier ------------------------------------------------------------------


@query
def term_freq(spark: SparkSession, folder: str) -> DataFrame:
    return features.term_freq(features.with_tokens(load(spark, folder, "documents")), "doc_id")


@query
def idf(spark: SparkSession, folder: str) -> DataFrame:
    weights = features.idf(load(spark, folder, "documents"), term_freq(spark, folder))
    return weights.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def tfidf(spark: SparkSession, folder: str) -> DataFrame:
    """Texts are tokenized and stemmed once; the weights and the join read the written terms."""
    terms = stage(term_freq(spark, folder), "terms")
    weights = stage(features.idf(load(spark, folder, "documents"), terms), "idf")
    weighted = features.tfidf(terms, weights, "doc_id")
    return weighted.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


def _model(spark: SparkSession, folder: str) -> classify.NaiveBayesTables:
    docs = features.with_tokens(labelled_documents(spark, folder), stemmed=False)
    return classify.train_tables(
        docs, scratch_path(spark, "tables"), training=classify.in_training(F.col("doc_id")), stemmed=False
    )


@query
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "labels").select(
        "doc_id", classify.in_training(F.col("doc_id")).alias("training")
    )


@query
def nb_priors(spark: SparkSession, folder: str) -> DataFrame:
    return _model(spark, folder).priors.select("label", "n_docs", F.round("log_prior", 6).alias("log_prior"))


@query
def nb_likelihoods(spark: SparkSession, folder: str) -> DataFrame:
    return _model(spark, folder).likelihoods().select(
        "label", "term", F.round("log_likelihood", 6).alias("log_likelihood")
    )


@query
def nb_predict(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id")
    return _model(spark, folder).predict(term_freq(spark, folder), docs, "doc_id")


@query
def nb_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    held_out = labelled_documents(spark, folder).filter(~classify.in_training(F.col("doc_id")))
    terms = features.term_freq(features.with_tokens(held_out), "doc_id")
    predicted = _model(spark, folder).predict(terms, held_out.select("doc_id", "label"), "doc_id")
    return classify.accuracy(predicted).select(F.round("accuracy", 6).alias("accuracy"), "n")


def _fitted(spark: SparkSession, folder: str):
    docs = features.with_tokens(labelled_documents(spark, folder)).select("doc_id", "label", "tokens")
    docs = stage(docs, "tokens")
    return classify.fit_pipeline(docs, training=classify.in_training(F.col("doc_id")))


@query
def nb_ml_predict(spark: SparkSession, folder: str) -> DataFrame:
    """The saved and restored pyspark.ml model on all documents."""
    path = scratch_path(spark, "model")
    _fitted(spark, folder).write().overwrite().save(path)
    docs = features.with_tokens(load(spark, folder, "documents"))
    return jobs.load_model(path).transform(docs).select("doc_id", "prediction")


# -- repeats, sources, documents --------------------------------------------------------------


@query
def dedup_posts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.first_arrivals(posts(spark, folder)).select("id", "repeat_key")


def _split_by_time(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    every = posts(spark, folder)
    day = _at(DAY_ELEVEN)
    stored = to_documents(dedup.first_arrivals(every.filter(F.col("created_at") < day)))
    return stored, every.filter(F.col("created_at") >= day)


@query
def dedup_vs_store(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving posts against the key index of the stored ones."""
    root = scratch_path(spark, "store")
    stored, arriving = _split_by_time(spark, folder)
    hashes = dedup.stored_keys(stored, "created_at").select(*keyindex.key_hashes(F.col("repeat_key")), "created_at")
    parts = keyindex.write_keys(hashes, root, 0)
    versions.commit(spark, root, versions.replacing_batch(0, (keyindex.KEYS, keyindex.FILTERS), parts))
    return dedup.unseen_posts(arriving, root).select("id", "repeat_key")


@query
def insert_status(spark: SparkSession, folder: str) -> DataFrame:
    stored, arriving = _split_by_time(spark, folder)
    keyed = dedup.with_repeat_key(arriving).select("id", "created_at", "repeat_key")
    return dedup.insert_status(stage(keyed, "keys"), stored).select("id", "status")


@query
def aggregator_flag(spark: SparkSession, folder: str) -> DataFrame:
    return flag_aggregators(posts(spark, folder), SURROGATE_SITES).select("id", "third_party")


@query
def aggregator_flag_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a name for each document, its language and id, looked for in the posts' sources."""
    names = load(spark, folder, "documents").select(F.concat_ws("/", "lang", "doc_id").alias("site"))
    return flag_aggregators(posts(spark, folder).select("id", "source"), names).select("id", "third_party")


@query
def post_document(spark: SparkSession, folder: str) -> DataFrame:
    return to_documents(posts(spark, folder), SURROGATE_SITES).select(
        "post_id", "source", "tweet_id", "text", "favorites", "place",
        F.col("user.id").alias("user_id"), F.col("user.screen_name").alias("user_name"),
        "phone", "email", "link", "hash", times.epoch_ms(F.col("created_at")).alias("created_ms"),
        "third_party",
    )


@query
def page_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    """Contacts of the page each post comes from."""
    linked = posts(spark, folder).select("id", F.col("source").alias("link"))
    found = enrich.with_page_contacts(linked, load(spark, folder, "pages"))
    return found.select(
        "id",
        text.list_text(F.sort_array("phone")).alias("phone"),
        text.list_text(F.sort_array("email")).alias("email"),
    )


@query
def retention(spark: SparkSession, folder: str) -> DataFrame:
    cutoff = retention_cutoff(_at(RETENTION_NOW))
    return retain(posts(spark, folder), cutoff).select("id")


# -- graph ------------------------------------------------------------------------------------


def _graph_rows(spark: SparkSession, folder: str) -> DataFrame:
    first = dedup.first_derived(partial(posts, spark, folder))
    return graph.graph_rows(to_documents(first, SURROGATE_SITES))


def _stored_graph_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Rows written once, for graphs that are built from them in several steps."""
    rows = _graph_rows(spark, folder)
    return stage(rows.select(*columns) if columns else rows, "rows")


@query
def graph_persons(spark: SparkSession, folder: str) -> DataFrame:
    return graph.persons(_graph_rows(spark, folder))


@query
def graph_tweets(spark: SparkSession, folder: str) -> DataFrame:
    return graph.whole_posts(_stored_graph_rows(spark, folder)).withColumn("tags", _joined(F.col("tags"), ","))


@query
def graph_tags(spark: SparkSession, folder: str) -> DataFrame:
    return graph.tags(_graph_rows(spark, folder))


@query
def graph_posted(spark: SparkSession, folder: str) -> DataFrame:
    return graph.posted(_graph_rows(spark, folder))


@query
def graph_tagged(spark: SparkSession, folder: str) -> DataFrame:
    return graph.tagged(_graph_rows(spark, folder))


@query
def graph_posted_vertices(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored_graph_rows(spark, folder)
    return graph.posted_vertices(graph.posted(rows), graph.posts(rows))


@query
def graph_tagged_vertices(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored_graph_rows(spark, folder)
    return graph.tagged_vertices(graph.tagged(rows), graph.posts(rows))


@query
def graph_names(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored_graph_rows(spark, folder)
    return graph.names(graph.persons(rows), graph.posts(rows), graph.tags(rows))


@query
def edge_all_ok(spark: SparkSession, folder: str) -> DataFrame:
    """Posts of all days against the tag edges made from the eleventh day on."""
    rows = _stored_graph_rows(spark, folder, "post_id", "tweet_id", "created_ms", "tags")
    late = rows.filter(F.col("created_ms") >= F.unix_millis(_at(DAY_ELEVEN)))
    return graph.all_edges_made(rows, graph.tagged(late))


@query
def recommend(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored_graph_rows(spark, folder, "person_id", "post_id", "created_ms", "tags")
    return graph.recommend(rows).withColumn("rank", F.col("rank").cast("bigint"))


# -- sources and sinks ------------------------------------------------------------------------


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of all posts, some damaged: no base64, no JSON, or null."""
    return _damaged_messages(posts(spark, folder))


def _kind() -> Column:
    """What becomes of a post's message: damaged in two ways, null with 2 or without a kind, and else whole."""
    return F.col("favorites") % 7


def _damaged_messages(every: DataFrame, *keep: str) -> DataFrame:
    fields = F.struct(*messages.POST_FIELDS)
    kind = _kind()
    value = (
        F.when(kind == 0, "!!!notb64")
        .when(kind == 1, F.base64(F.lit("{bad").cast("binary")))
        .when(kind != 2, messages.encode_post(fields))
    )
    return every.select(F.col("id").alias("message"), value.alias("value"), *keep)


@query
def envelope_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    decoded = messages.decode_messages(_damaged(spark, folder), "message")
    return decoded.select(
        "message",
        F.col("post").isNotNull().alias("ok"),
        F.md5("post.text").alias("text_md5"),
        times.epoch_ms(F.col("post.created_at")).alias("created_ms"),
        F.col("post.user.screen_name").alias("user_name"),
        F.col("post.retweeted.id").alias("retweeted_id"),
    )


@query
def corpus_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as a corpus and read back."""
    path = scratch_path(spark, "corpus")
    found = load(spark, folder, "documents").select(
        F.concat(F.col("source"), F.lit("\n"), F.col("lang")).alias("username"),
        F.col("doc_id").alias("id"),
        times.format_corpus_time(F.timestamp_seconds(F.col("doc_id") * 3600)).alias("created_at"),
        F.concat(F.lit("| "), F.col("lang"), F.lit("\n |")).alias("location"),
        "text",
        (F.col("lang") == "en").cast("int").alias("en"),
    )
    corpus.append_corpus(found, path, F.col("en"))
    return corpus.read_corpus(spark, path).select(
        "id", "username", times.epoch_ms(F.col("created_at")).alias("created_ms"), "location", "text", "label"
    )


@query
def search_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations packed into responses of at most 100 statuses and taken apart again."""
    turns = load(spark, folder, "conversations")
    status = F.struct(
        times.format_corpus_time(F.timestamp_seconds("turn")).alias("created_at"),
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("id"),
        F.col("text"),
        F.struct(F.col("role").alias("name"), F.lit("").alias("location")).alias("user"),
    )
    responses = (
        turns.groupBy("conv_id", F.floor(F.col("turn") / 100))
        .agg(F.collect_list(status).alias("statuses"))
        .select(F.to_json(F.struct("statuses")).alias("value"))
    )
    return search.found_posts(search.parse_responses(responses))


# -- streams ----------------------------------------------------------------------------------


def _thirds(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' texts as files that a stream takes in three batches, by id."""
    path = scratch_path(spark, "thirds")
    docs = load(spark, folder, "documents")
    n = docs.select(F.count(F.lit(1))).scalar()
    third = F.floor(F.col("doc_id") * 3 / n).cast("int")
    docs.select("text", third.alias("third")).write.partitionBy("third").parquet(path)
    return spark.readStream.schema("text string, third int").parquet(path).select("text", "third")


@query
def stream_word_count(spark: SparkSession, folder: str) -> DataFrame:
    return streams.run_counts(_thirds(spark, folder), scratch_path(spark, "counts"), scratch_path(spark, "checkpoint"))


@query
def stream_word_count_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The words of each of three batches; the stream runs three times, each time over one more third."""
    path, checkpoint, inbox = (scratch_path(spark, name) for name in ("counts", "checkpoint", "inbox"))
    docs = load(spark, folder, "documents").select("doc_id", "text")
    n = docs.select(F.count(F.lit(1))).scalar()
    for third in range(3):
        docs.filter(F.floor(F.col("doc_id") * 3 / n) == third).select("text").write.mode("append").parquet(inbox)
        found = streams.run_batch_counts(spark.readStream.schema("text string").parquet(inbox), path, checkpoint)
    return found.select("batch_id", "word", "n")


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = streams.without_repeats(post_stream(spark, folder)).select("repeat_key")
    return streams.run_to_files(kept, scratch_path(spark, "kept"), scratch_path(spark, "checkpoint"))


@query
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed posts scored by the model of tables, batch by batch."""
    return streams.run_scores(
        post_stream(spark, folder), _model(spark, folder), scratch_path(spark, "scored"), scratch_path(spark, "checkpoint"),
    ).select("id", "matched", "prediction")


DAYS_OF_BATCHES = ("2024-01-01", "2024-01-11", "2024-01-21", "2025-01-01")


def _days() -> list[Column]:
    """Which of three parts of the time a post is of."""
    created = F.col("created_at")
    return [(created >= _at(a)) & (created < _at(b)) for a, b in zip(DAYS_OF_BATCHES, DAYS_OF_BATCHES[1:])]


def _deliver(spark: SparkSession, every: DataFrame) -> str:
    """Messages of all posts, written once and packed, as one folder for each part of the time. Posts whose message is null are
    left out by their kind, so that no message is made twice."""
    path, days = scratch_path(spark, "deliveries"), _days()
    delivery = F.coalesce(*[F.when(day, F.lit(n)) for n, day in enumerate(days)])
    sent = every.withColumn("delivery", delivery).filter(F.col("delivery").isNotNull() & F.coalesce(_kind() != 2, F.lit(False)))
    dealt = _damaged_messages(sent, "delivery").select("delivery", "value")
    limit = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(len(days)))  # a file for each part is open, so messages are not sorted by it
    try:
        packed = dealt.write.partitionBy("delivery").options(**{"compression": "gzip", "zlib.compress.level": "FOUR"})
        packed.text(path)
    finally:
        spark.conf.set(limit, before)
    return path


def _fed(spark: SparkSession, folder: str, start) -> str:
    """A store that a streaming job has filled: it is started again for each of three deliveries of messages."""
    inbox, root, checkpoint = (scratch_path(spark, name) for name in ("inbox", "store", "checkpoint"))
    model = _model(spark, folder)
    deliveries = _deliver(spark, posts(spark, folder))
    for n in range(len(_days())):
        if not stores.move_folder(spark, f"{deliveries}/delivery={n}", f"{inbox}/{n}"):
            spark.createDataFrame([], "value string").write.text(f"{inbox}/{n}")
        arriving = messages.read_message_files(spark, inbox, recursiveFileLookup="true")
        running = start(arriving, model, root, checkpoint, interval=None, sites=SURROGATE_SITES)
        for query_ in running if isinstance(running, list) else [running]:
            query_.awaitTermination()
    return root


@query
def stream_store(spark: SparkSession, folder: str) -> DataFrame:
    """Messages in files through the whole streaming job; what the document table then holds."""
    root = _fed(spark, folder, streams.start_store)
    return stores.read(spark, root, "documents").select("post_id", "tweet_id", "link", "hash", "third_party")


@query
def stream_store_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What the job counted of each batch's messages."""
    return stores.read(spark, _fed(spark, folder, streams.start_store), "counts").select("batch_id", "messages", "rejected", "stored")


@query
def stream_store_by_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the repeats known to Spark's state; what the tag edges then are."""
    return stores.read_edges(spark, _fed(spark, folder, streams.start_store_by_state), "tagged").select("tweet_id", "tag")


def _filled(spark: SparkSession, folder: str) -> str:
    """A store of all posts but repeats, in three batches."""
    root = scratch_path(spark, "store")
    stores.create(spark, root)
    keyed = dedup.with_repeat_key(posts(spark, folder))
    keys = stage(keyed.select("id", "created_at", "repeat_key"), "keys")
    for batch_id, day in enumerate(_days()):
        fresh = dedup.unseen_derived(partial(posts, spark, folder), keys.filter(day), root, batch_id)
        stores.append_documents(to_documents(fresh, SURROGATE_SITES), root, batch_id)
    return root


@query
def store_upkeep(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a store after compaction, retention and the removal of old files."""
    root = _filled(spark, folder)
    stores.compact_documents(spark, root, 2)
    stores.purge_documents(spark, root, retention_cutoff(_at(RETENTION_NOW)))
    stores.vacuum(spark, root, versions_kept=1, older_ms=0)
    return stores.read(spark, root, "documents").select("post_id", "hash", (F.col("batch_id") < 0).alias("merged"))


@query
def store_bot_check(spark: SparkSession, folder: str) -> DataFrame:
    """The scores on the documents of a store, after a run over a batch of people and one over the others."""
    root = _filled(spark, folder)
    rows = graph.graph_rows(stores.read(spark, root, "documents"))
    stores.append_graph(rows, root, 0)
    for run, batch in enumerate((PEOPLE_BATCH, None)):
        jobs.check_store(spark, root, history(spark, folder), run, batch)
    return stores.scored_documents(spark, root).select("post_id", "metadata.*")
