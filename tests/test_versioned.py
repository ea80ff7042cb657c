"""A load is seen whole or not at all, and a replay counts like the first try."""

import pytest

from horavento.plans.file_queries import raw_files
from horavento.sources import versioned
from horavento.streaming import ingest as I
from tests.conftest import SF001


def files(spark):
    return spark.read.format("binaryFile").schema(I.BINARY_FILE_SCHEMA).option("recursiveFileLookup", "true").load(raw_files(spark, SF001))


def rows(df):
    return sorted(map(str, df.select("estacao", "data", "hora", "temperatura", "umidade", "velocidade_vento").collect()))


def counts(df):
    return sorted((r.arquivo_s3, r.registros_inseridos, r.registros_atualizados, r.status) for r in df.collect())


def test_a_fault_between_data_and_ledger_leaves_the_old_version(spark, workdir, monkeypatch):
    batch = files(spark)
    paths = sorted(r.path for r in batch.select("path").collect())
    first, second = batch.where(batch.path == paths[0]), batch.where(batch.path != paths[0])
    assert I.ingest_versioned(spark, first, workdir).number == 1
    old_rows, old_ledger = rows(I.table_of(spark, workdir)), counts(I.ledger_of(spark, workdir))
    assert old_rows and [c[0] for c in old_ledger] == paths[:1]

    publish = versioned._publish
    def fail(*_):
        raise OSError("lost between data and ledger")
    for broken in ("_partitions", "_publish"):  # after the data, and after data and ledger
        with monkeypatch.context() as m:
            m.setattr(versioned, broken, fail)
            with pytest.raises(OSError):
                I.ingest_versioned(spark, second, workdir)
        assert versioned.version(spark, workdir).number == 1
        assert rows(I.table_of(spark, workdir)) == old_rows and counts(I.ledger_of(spark, workdir)) == old_ledger
    assert versioned._publish is publish

    v = I.ingest_versioned(spark, second, workdir)
    ledger = counts(I.ledger_of(spark, workdir))
    assert v.number == 2 and [c[0] for c in ledger] == paths
    assert all(inserted > 0 and updated == 0 and status == "sucesso" for _, inserted, updated, status in ledger)
    assert sum(c[1] for c in ledger) == len(rows(I.table_of(spark, workdir)))
    # old versions stay readable, and loaded files aren't loaded again
    assert rows(I.table_of(spark, workdir, 1)) == old_rows and I.table_of(spark, workdir, 0).count() == 0
    assert I.ingest_versioned(spark, batch, workdir).number == 2


def test_a_taken_version_is_refused(spark, workdir):
    batch = files(spark)
    base = versioned.version(spark, workdir)
    assert base.number == 0 and I.ledger_of(spark, workdir).collect() == []
    I.ingest_versioned(spark, batch, workdir)
    none = spark.createDataFrame([], I.TABLE_SCHEMA), spark.createDataFrame([], I.LEDGER_SCHEMA)
    with pytest.raises(RuntimeError):
        versioned.commit(spark, workdir, base, *none, I.TABLE_PARTITIONS)
    with pytest.raises(ValueError):
        versioned.version(spark, workdir, 7)
