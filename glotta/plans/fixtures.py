"""Views of the synthetic tables that stand in for speech corpora.

Each view exists as a DataFrame here and as a SQL text in ``SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import table


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    prefix = F.when(i % 3 == 0, "cerebral_").when(i % 3 == 1, "tts_").otherwise("x_")
    stem = F.concat(prefix, F.format_string("%04d", i))
    source = F.when(i % 4 == 0, "cerebral_pdf").when(i % 4 == 1, "tts_rapport").when(i % 4 == 2, "long_original").otherwise(F.col("source"))
    return d.select(
        i.alias("pos"),
        i.cast("string").alias("id"),
        stem.alias("stem"),
        F.concat(F.lit("data/wav/"), stem, F.lit(".wav")).alias("audio_path"),
        F.col("text").alias("transcription"),
        source.alias("source"),
        F.round(F.col("n_chars") / 150.0, 3).alias("duration_s"),
        F.when(i % 50 == 0, 8000).otherwise(16000).alias("sample_rate"),
        F.when(i % 37 == 0, "fichier introuvable").alias("audio_err"),
    )


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference texts: of labelled documents."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos")).distinct()
    return clips(spark, sf_dir).join(labels, "pos", "left_semi").select("pos", "stem", F.col("transcription").alias("text"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clips(spark, sf_dir).where("audio_err is null").select("pos", "stem", "audio_path")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", start.alias("s"), (start + F.floor(F.col("value") * 60000000).cast("long")).alias("e"))


def clips_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select("user_id", pos.alias("pos"), F.round(F.col("value") / 10.0, 3).alias("dur"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


def pcm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number samples: the signals times 20,000."""
    return signals(spark, sf_dir).select("vec_id", F.transform("x", lambda v: F.round(v * 20000).cast("int")).alias("x"))


def utterance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn and the next one as reference and hypothesis."""
    from ..functions.text import words

    c = table(spark, sf_dir, "conversations")
    text = F.array_join(words(F.lower("text")), " ")
    w = Window.partitionBy("conv_id").orderBy("turn")
    pairs = c.select("conv_id", "turn", text.alias("ref"), F.lead(text).over(w).alias("hyp"), (F.lead("turn").over(w) - F.col("turn")).alias("step"))
    return pairs.where("step = 1").drop("step")


def mic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictation commands and audio blocks: f1 start, f2 pause, f3 end."""
    kind = F.when(F.col("event_type") == "signup", "f1").when(F.col("event_type") == "click", "f2").when(F.col("event_type") == "purchase", "f3").otherwise("chunk")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("session"), "ts", "event_id", kind.alias("kind"), "value")


def markup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "<[^>]*>", "\n").alias("text"))


SQL = {
    "clips": """clips AS (SELECT doc_id AS pos, doc_id::VARCHAR AS id,
  (CASE doc_id % 3 WHEN 0 THEN 'cerebral_' WHEN 1 THEN 'tts_' ELSE 'x_' END) || printf('%04d', doc_id) AS stem,
  'data/wav/' || (CASE doc_id % 3 WHEN 0 THEN 'cerebral_' WHEN 1 THEN 'tts_' ELSE 'x_' END) || printf('%04d', doc_id) || '.wav' AS audio_path,
  text AS transcription, CASE doc_id % 4 WHEN 0 THEN 'cerebral_pdf' WHEN 1 THEN 'tts_rapport' WHEN 2 THEN 'long_original' ELSE source END AS source,
  round(n_chars / 150.0, 3) AS duration_s, CASE doc_id % 50 WHEN 0 THEN 8000 ELSE 16000 END AS sample_rate,
  CASE WHEN doc_id % 37 = 0 THEN 'fichier introuvable' END AS audio_err FROM documents)""",
    "meta": "meta AS (SELECT pos, stem, transcription AS text FROM clips WHERE pos IN (SELECT doc_id FROM labels))",
    "files": "files AS (SELECT pos, stem, audio_path FROM clips WHERE audio_err IS NULL)",
    "segments": "segments AS (SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + floor(value * 60000000)::BIGINT AS e FROM events)",
    "clips_keyed": "clips_keyed AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, round(value / 10.0, 3) AS dur FROM events)",
    "signals": "signals AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)",
    "pcm": "pcm AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda v: round(v * 20000)::INT) AS x FROM embeddings)",
    # word edits row by row: each takes the row above and the costs of one word
    "utterances": r"""heads AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '\S+') AS w FROM conversations),
pairs AS (SELECT a.conv_id, a.turn, a.w AS r, b.w AS h FROM heads a JOIN heads b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
costs AS (SELECT conv_id, turn, len(r) AS n, len(h) AS m, list_transform(r, lambda a: list_transform(h, lambda b: CASE WHEN a = b THEN 0 ELSE 1 END)) AS c FROM pairs),
rows AS (SELECT conv_id, turn, n, m, list_reduce(c, lambda p, k: list_transform(
  [list_transform(range(1, m + 2), lambda i: (CASE WHEN i = 1 THEN p[1] + 1 ELSE least(p[i] + 1, p[i - 1] + k[i - 1]) END) - (i - 1))],
  lambda q: list_transform(range(1, m + 2), lambda j: j - 1 + list_min(q[1:j])))[1], range(m + 1)) AS row FROM costs),
edits AS (SELECT conv_id, turn, n, m, CASE WHEN n = 0 THEN m ELSE row[-1] END AS e FROM rows)""",
    "mic": "mic AS (SELECT user_id AS session, ts, event_id, CASE event_type WHEN 'signup' THEN 'f1' WHEN 'click' THEN 'f2' WHEN 'purchase' THEN 'f3' ELSE 'chunk' END AS kind, value FROM events)",
}


def sql(query: str, *views: str) -> str:
    """``query`` with the views that it reads before it; it may begin with a
    comma and go on with views of its own."""
    return "WITH " + ",\n".join(SQL[v] for v in views) + ("" if query.lstrip().startswith(",") else "\n") + query
