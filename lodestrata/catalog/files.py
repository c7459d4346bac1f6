"""Tables written out in the file forms the engine reads, and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lodestrata import schemas
from lodestrata.catalog.registry import query
from lodestrata.catalog.roles import table
from lodestrata.session import shared_folder
from lodestrata.sinks import tables as sink
from lodestrata.sources import files, topics
from lodestrata.streaming.epochs import run_available, write_epoch


@query(
    """SELECT (s_suppkey // 20)::INT AS block, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance
    FROM supplier GROUP BY 1"""
)
def document_files(spark, sf_dir):
    """One document a file and block of suppliers, through the fallback for a missing topic."""
    root = shared_folder(spark)
    block = F.floor(F.col("s_suppkey") / 20).cast("int")
    totals = table(spark, sf_dir, "supplier").groupBy(block.alias("block")).agg(
        F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance")
    )
    document = F.to_json(F.struct("block", "suppliers", "balance"))
    sink.by_folder(totals.select(document.alias("value"), F.col("block").alias("part")), "part").write.partitionBy(
        "part"
    ).text(f"{root}/raw")
    read = topics.read_messages(spark, "youtube", path=f"{root}/raw")
    absent = topics.read_messages(spark, "youtube", path=f"{root}/absent")
    fields = F.from_json("value", "block INT, suppliers BIGINT, balance DOUBLE")
    return read.unionByName(absent).select(fields.alias("d")).select("d.*")


@query(
    """SELECT p_name AS song, p_partkey::VARCHAR AS song_code, p_brand AS original_artist FROM part"""
)
def catalogue_file(spark, sf_dir):
    """A song sheet with columns nobody asked for, by its column names."""
    path = f"{shared_folder(spark)}/sheet"
    sheet = table(spark, sf_dir, "part").select(
        F.col("p_size").alias("NO"),
        F.col("p_partkey").alias("CODE"),
        F.col("p_name").alias("SONG TITLE"),
        F.col("p_brand").alias("ORIGINAL ARTIST"),
        F.col("p_type").alias("NOTE, FREE"),
    )
    sheet.write.option("header", True).csv(path)
    return files.catalogue_songs(files.read_catalogue(spark, path))


@query(
    """SELECT event_id::VARCHAR AS id_asesmen, nullif(event_type, 'click') AS jenis_asmed, props AS asmed,
      date_trunc('second', ts) AS waktu_input FROM events"""
)
def delimited_append(spark, sf_dir):
    """Delimited rows with quoted JSON, some fields empty, parsed and appended in two loads."""
    root = shared_folder(spark)
    names = [c.split()[0] for c in files.ASSESSMENT_SCHEMA.split(", ")]
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id_asesmen"),
        F.nullif(F.col("event_type"), F.lit("click")).alias("jenis_asmed"),
        F.col("props").alias("asmed"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("waktu_input"),
        (F.col("event_id") % 2).alias("load"),
    )
    filled = {c: F.lit(None).cast("string") for c in names if c not in rows.columns}
    filled["user_input"] = F.lit("user;one")
    for load in (0, 1):
        path = f"{root}/load={load}"
        part = rows.filter(F.col("load") == load).withColumns(filled).select(*names)
        part.write.options(sep=";", header=True, quote='"', escape='"').csv(path)
        sink.append(files.read_delimited(spark, path), f"{root}/table")
    return spark.read.parquet(f"{root}/table").select("id_asesmen", "jenis_asmed", "asmed", "waktu_input")


@query("""SELECT event_type, count(*) AS jobs, sum((props::JSON->>'k')::BIGINT)::BIGINT AS k FROM events GROUP BY 1""")
def job_queue(spark, sf_dir):
    """Job bodies as JSON lines; the run ends when the queue is empty."""
    root = shared_folder(spark)
    body = F.to_json(F.struct("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
    lines = table(spark, sf_dir, "events").select(F.explode(F.array(body, F.lit(" "))).alias("value"))
    lines.write.text(f"{root}/queue")

    def each(batch, epoch):
        jobs = batch.select(F.from_json("value", "event_type STRING, k BIGINT").alias("j")).select("j.*")
        write_epoch(jobs, f"{epoch:010d}", f"{root}/done")

    run_available(files.read_jobs(spark, f"{root}/queue"), f"{root}/checkpoint", each)
    done = spark.read.parquet(f"{root}/done")
    return done.groupBy("event_type").agg(F.count("*").alias("jobs"), F.sum("k").alias("k"))


@query(
    """SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1
    UNION ALL SELECT 'tables', 1"""
)
def written_tables(spark, sf_dir):
    """A set of tables below one folder; the empty one is left out."""
    root = shared_folder(spark)
    counts = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("orders")
    )
    written = sink.write_tables({"by_status": counts, "none": counts.filter("orders < 0")}, root)
    rows = spark.read.parquet(f"{root}/by_status")
    return rows.unionByName(rows.limit(1).select(F.lit("tables").alias("status"), F.lit(len(written)).cast("bigint").alias("orders")))


@query("""SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""")
def dropped_days(spark, sf_dir):
    """Day folders beyond the keeping time are removed from a table."""
    path = f"{shared_folder(spark)}/days"
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("ingest_date"))
    sink.append(rows, path, ["ingest_date"])
    sink.drop_days(spark, path, date(2024, 1, 15))
    return spark.read.parquet(path).select("event_id", "ts")


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
      CASE WHEN event_type <> 'view' THEN event_type END AS event_type FROM events"""
)
def null_values(spark, sf_dir):
    """Chosen columns of a delimited file; NaN and empty fields are null."""
    path = f"{shared_folder(spark)}/values"
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", "props", value.alias("value"), kind.alias("event_type"))
    rows.write.option("header", True).csv(path)
    read = spark.read.option("header", True).schema("event_id BIGINT, props STRING, value DOUBLE, event_type STRING").csv(path)
    return files.column_subset(read, ["event_id", "value", "event_type"])


@query(
    """SELECT c_custkey::VARCHAR AS artist_id, c_name AS artist_name, NULL::VARCHAR AS spotify_url FROM customer"""
)
def created_tables(spark, sf_dir):
    """Tables created where they are missing, twice, and filled."""
    root = shared_folder(spark)
    name = f"made_{root[-12:]}"
    for _ in range(2):
        sink.create_tables(spark, name, ("silver",), f"{root}/database")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("artist_id"), F.col("c_name").alias("artist_name")
    )
    schemas.conform(rows, "silver_spotify_artist").write.insertInto(f"{name}.silver_spotify_artist")
    return spark.table(f"{name}.silver_spotify_artist").select("artist_id", "artist_name", "spotify_url")
