from panelweave import session


def test_partitions_grow_with_the_input(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"x" * 1000)
    (tmp_path / "y.bin").write_bytes(b"y" * 24)
    assert session.input_bytes(spark, str(tmp_path)) == 1024
    assert session.shuffle_partitions(1024) == 1
    assert session.shuffle_partitions(1024**4) == 8192
    assert session.shuffle_partitions(100 * 1024**4) == 819_200


def test_configured_number_is_the_least(spark, tmp_path, monkeypatch):
    (tmp_path / "x.bin").write_bytes(b"x" * 1000)
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "7")
    assert session.size_shuffles(own, str(tmp_path)) == 7
    monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", 400)
    assert session.size_shuffles(own, str(tmp_path)) == 10
    assert own.conf.get("spark.sql.shuffle.partitions") == "10"


def test_settings_are_applied(spark):
    for name, value in session.SETTINGS.items():
        assert spark.conf.get(name) == value
