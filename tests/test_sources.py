import pytest

from helpers import bag, rows, text_frame
from tierline import session, sources
from tierline.schemas import RAW
from tierline.session import MIB

LOOKUP = RAW["product_category_translation"]


def write(folder, name, data: bytes):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data)
    return str(folder / name)


def read(spark, path, schema=LOOKUP, **options):
    return sources.ingest_raw(spark, path, schema, **options)


def test_bom_crlf_and_lineage(spark, tmp_path):
    path = write(tmp_path, "look.csv", "\ufeffname,english\r\nbebês,babies\r\nação,action\r\n".encode())
    df = read(spark, path)
    assert df.columns == [*LOOKUP.names, "_ingested_at", "_source_file"]
    assert bag(df.select(*LOOKUP.names)) == [("ação", "action"), ("bebês", "babies")]
    assert {r["_source_file"] for r in df.collect()} == {"look.csv"}
    assert df.filter("_ingested_at IS NULL").count() == 0


def test_columns_are_bound_by_position(spark, tmp_path):
    path = write(tmp_path, "a.csv", b"english,name\nx,y\n")
    assert rows(read(spark, path).select(*LOOKUP.names)) == [("x", "y")]


def test_quotes_blanks_short_and_long_lines(spark, tmp_path):
    text = b'a,b\n"l, m",\n,"x \\"q\\" y"\n"",1\nshort\n1,2,3\n"C:\\\\d",e\n'
    got = bag(read(spark, write(tmp_path, "a.csv", text)).select(*LOOKUP.names))
    assert got == sorted(
        [("l, m", ""), ("", 'x "q" y'), ("", "1"), ("short", ""), ("1", "2"), ("C:\\d", "e")]
    )


def test_doubled_quotes_and_line_breaks_on_request(spark, tmp_path):
    path = write(tmp_path, "a.csv", b'a,b\n"say ""hi"", ok",1\n"two\nlines",2\n')
    df = read(spark, path, escape='"', multi_line=True)
    assert bag(df.select(*LOOKUP.names)) == [('say "hi", ok', "1"), ("two\nlines", "2")]


def test_many_part_files_each_with_a_header(spark, tmp_path):
    for i in range(3):
        write(tmp_path / "in", f"part{i}_category_name_translation.csv", f"a,b\nk{i},v{i}\n".encode())
    df = read(spark, f"{tmp_path}/in/*category_name_translation.csv")
    assert bag(df.select("product_category_name", "_source_file")) == [
        (f"k{i}", f"part{i}_category_name_translation.csv") for i in range(3)
    ]


def test_write_replaces_and_partitions(spark, tmp_path):
    path = sources.layer_path(f"{tmp_path}/", "silver", "t")
    assert path == f"{tmp_path}/silver/t"
    df = text_frame(spark, ["k", "m"], [("a", "x"), ("b", "y"), ("c", "y")])
    sources.write_table(df, path)
    sources.write_table(df.filter("k <> 'a'"), path)
    assert bag(sources.read_table(spark, path, df.schema)) == [("b", "y"), ("c", "y")]
    sources.write_table(df, f"{path}_by_m", ["m"])
    parts = sources.read_table(spark, f"{path}_by_m")
    assert bag(parts.filter("m = 'y'").select("k")) == [("b",), ("c",)]
    assert sorted(p.name for p in (tmp_path / "silver" / "t_by_m").glob("m=*")) == ["m=x", "m=y"]


def test_catalog_layers(spark, tmp_path):
    layers = ["unit_bronze", "unit_gold"]
    sources.create_layers(spark, layers, root=str(tmp_path), drop_existing=True)
    df = text_frame(spark, ["k"], [("a",), ("b",)])
    sources.publish_table(df, "unit_gold", "two")
    published = sources.publish_table(df.filter("k = 'a'"), "unit_gold", "one")
    assert rows(published) == [("a",)]
    sources.write_table(df.union(df), f"{tmp_path}/plain")
    sources.register_table(spark, "unit_gold", "four", f"{tmp_path}/plain")
    wanted = [("four", 4), ("one", 1), ("two", 2)]
    assert bag(sources.list_layer(spark, "unit_gold")) == wanted
    # Publishing again replaces the rows; a temporary view is not part of a layer.
    sources.publish_table(df, "unit_gold", "two")
    df.createOrReplaceTempView("unit_view")
    assert bag(sources.list_layer(spark, "unit_gold")) == wanted
    sources.create_layers(spark, layers, root=str(tmp_path), drop_existing=True)
    assert spark.catalog.listTables("unit_gold") == [] or all(
        t.isTemporary for t in spark.catalog.listTables("unit_gold")
    )


class Cluster:
    """As much of a session as the choice of a shared folder looks at."""

    class sparkContext:
        master, applicationId = "spark://somewhere:7077", "app"

    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name.replace(".", "_"), default)


def test_shared_folder_follows_the_cluster_setting():
    cluster = Cluster(spark_checkpoint_dir="/shared/place/")
    first, second = session.shared_folder(cluster), session.shared_folder(cluster)
    assert first.startswith("/shared/place/tierline-app-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster())


def test_sizing(spark, tmp_path, settings):
    write(tmp_path / "x", "a.bin", b"1" * 1000)
    write(tmp_path / "y" / "z", "b.bin", b"1" * 500)
    assert session.input_bytes(spark, str(tmp_path)) == 1500
    small, huge = session.sizing_for(1500), session.sizing_for(100 * 10**12)
    assert list(small.values()) == ["1", str(128 * MIB), str(64 * MIB), str(64 * MIB)]
    assert list(huge.values()) == ["100000", str(500 * 10**6), str(250 * 10**6), str(250 * 10**6)]
    settings(
        spark__sql__shuffle__partitions="7",
        spark__sql__files__maxPartitionBytes="256m",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1k",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="1k",
    )
    session.size_for(spark, 1500)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "256m"
    piece = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert spark.conf.get(piece) == str(64 * MIB)
    session.size_for(spark, 100 * 10**12)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "100000"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(500 * 10**6)


def test_layer_tables_are_written_with_zstd(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    sources.write_table(spark.range(10), f"{scratch}/zstd")
    files = glob.glob(f"{scratch}/zstd/*.parquet")
    assert files
    for file in files:
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
