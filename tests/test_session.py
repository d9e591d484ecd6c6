from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest

from voltlake.session import OPEN_FILES, OPEN_FILES_KEY, SETTINGS, sized_for, unsorted_writes


def test_session_settings(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


def test_shuffle_partitions_grow_with_the_data():
    counts = [int(sized_for(n)["spark.sql.shuffle.partitions"]) for n in (0, 2**30, 2**40, 100 * 2**40)]
    assert counts == [200, 200, 2048, 100_000]


def test_unsorted_writes_leave_the_session_as_it_was(spark):
    """The first thread to leave must not end the setting for the other, nor the last one keep it."""
    both, left = Barrier(2), Barrier(2)

    def first():
        with unsorted_writes(spark):
            both.wait(60)
        left.wait(60)

    def second():
        with unsorted_writes(spark):
            both.wait(60)
            left.wait(60)
            return spark.conf.get(OPEN_FILES_KEY)

    with ThreadPoolExecutor(2) as pool:
        runs = [pool.submit(f) for f in (first, second)]
        assert [r.result() for r in runs] == [None, str(OPEN_FILES)]
    assert spark.conf.get(OPEN_FILES_KEY, None) is None
    with pytest.raises(KeyError), unsorted_writes(spark):
        raise KeyError
    assert spark.conf.get(OPEN_FILES_KEY, None) is None
