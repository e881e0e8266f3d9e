from starsmelt.session import settings_for


def test_settings_follow_the_input():
    small, large = settings_for(10**7, 8), settings_for(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == 18_627
    assert {name for name in small if small[name] != large[name]} == {"spark.sql.shuffle.partitions"}


def test_settings_are_accepted(spark):
    for name, value in settings_for(10**9, 8).items():
        before = spark.conf.get(name, None)
        spark.conf.set(name, value)
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
