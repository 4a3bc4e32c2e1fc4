import pytest

from bulkapply import SinkOptions, TargetSpec
from bulkapply.options import seconds
from bulkapply.retry import with_retry
from bulkapply.sources.jdbc import JdbcTarget
from bulkapply.storage import shared_dir


def test_defaults():
    options = SinkOptions()
    assert (options.max_rows, options.interval, options.max_retries, options.retry_interval) == (1000, 5.0, 3, 1.0)
    assert (options.guarantee, options.parallelism, options.bulk) == ("AT_LEAST_ONCE", None, False)


@pytest.mark.parametrize(
    "bad",
    [
        {"max_rows": 0}, {"max_rows": -1}, {"interval": -1}, {"interval": 0}, {"max_retries": -1}, {"retry_interval": 0},
        {"guarantee": "EXACTLY_ONCE"}, {"guarantee": "SOMETIMES"}, {"parallelism": 0}, {"timestamp_digits": 7},
    ],
)
def test_bad_values(bad):
    with pytest.raises(ValueError):
        SinkOptions(**bad)


def test_from_table_options():
    options = SinkOptions.from_map(
        {
            "connector": "any", "url": "jdbc:x", "table-name": "t", "username": "u", "password": "p",
            "sink.buffer-flush.max-rows": "2", "sink.buffer-flush.interval": "0", "sink.max-retries": 5,
            "sink.retry.interval": "500ms", "sink.delivery-guarantee": "at-least-once", "sink.parallelism": "4",
            "sink.use-copy-protocol": "true",
        }
        | {"sink.buffer-flush.interval": "0s"}
    )
    assert options == SinkOptions(2, None, 5, 0.5, "AT_LEAST_ONCE", 4, True)
    with pytest.raises(ValueError, match="sink.unknown"):
        SinkOptions.from_map({"sink.unknown": 1})
    with pytest.raises(ValueError, match="both"):
        SinkOptions.from_map({"username": "u"})


def test_durations():
    assert [seconds(v) for v in ("5s", "500ms", "1 min", "2 h", 3)] == [5, 0.5, 60, 7200, 3]
    for bad in ("5", "s", "5 parsecs"):
        with pytest.raises(ValueError):
            seconds(bad)


def test_target_spec():
    assert TargetSpec("t", ["a"]).mode == "append"
    assert TargetSpec("t", ["a", "b"], ["a"]).mode == "upsert"
    for bad in (("", ["a"], []), ("t", ["a"], ["z"])):
        with pytest.raises(ValueError):
            TargetSpec(*bad)


def test_bulk_needs_append():
    with pytest.raises(ValueError, match="bulk"):
        SinkOptions(bulk=True).check_target(TargetSpec("t", ["a"], ["a"]))
    SinkOptions(bulk=True).check_target(TargetSpec("t", ["a"]))


def test_login_is_complete_and_hidden():
    spec = TargetSpec("t", ["a"])
    with pytest.raises(ValueError):
        JdbcTarget("jdbc:x", spec, user="u")
    with pytest.raises(ValueError):
        JdbcTarget("", spec)
    assert "secret" not in repr(JdbcTarget("jdbc:x", spec, "u", "secret"))


def test_retry_counts_and_waits():
    calls, waits = [], []

    def fails(times):
        def attempt():
            calls.append(1)
            if len(calls) <= times:
                raise OSError("no")
        return attempt

    assert with_retry(fails(3), SinkOptions(max_retries=3, retry_interval=2.0), waits.append) == 4
    assert waits == [0, 2, 4]
    calls.clear()
    with pytest.raises(OSError):
        with_retry(fails(9), SinkOptions(max_retries=1), waits.append)
    assert len(calls) == 2
    calls.clear()
    with pytest.raises(OSError):
        with_retry(fails(9), SinkOptions(max_retries=0), waits.append)
    assert len(calls) == 1


def test_shared_folder_is_the_session_s(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
