"""Files of a set length across batches, repeated batches, and the size of the state."""

from collections import Counter

import pytest
from helpers import rows

from postlark.session import folders
from postlark.streaming.landing import feed_stream
from postlark.streaming.rotation import Rotation, rotate


def feed(spark, first, last):
    return spark.range(first, last).selectExpr("CAST(id AS STRING) AS value")


def add_file(folder, name, first, last):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{n}\n" for n in range(first, last)))


def sizes(rotation):
    return dict(sorted(Counter(file for file, _ in rows(rotation.files())).items()))


def every_line(rotation):
    return sorted(
        [int(value) for _, value in rows(rotation.files())]
        + [int(value) for _, value in rows(rotation.open_lines())]
    )


def expected_sizes(n, lines_per_file, first):
    """A file is moved before the line that would be one too many is written."""
    out, held = [], 0
    for number in range(1, n + 1):
        held += 1
        if held == (first if not out else lines_per_file):
            out.append(held)
            held = 0
    return dict(enumerate(out)), held


@pytest.mark.parametrize("first", [None, 9, 1])
def test_files_have_a_set_length(spark, tmp_path, first):
    rotation = Rotation(spark, str(tmp_path / "out"), str(tmp_path / "check"), 10, first)
    assert sizes(rotation) == {} and every_line(rotation) == []
    cuts = [0, 3, 3, 47, 50, 60, 61]
    for batch, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        rotation.add(feed(spark, a, b), batch)
        full, left = expected_sizes(b, 10, first or 10)
        assert sizes(rotation) == full
        assert rotation.open_lines().count() == left
        assert every_line(rotation) == list(range(b))
    # Files hold the lines in their order, however tasks read them.
    assert [int(v) for f, v in sorted(rows(rotation.files())) if f == 0] == list(range(first or 10))


def test_repeated_batch_lands_once(spark, tmp_path):
    rotation = Rotation(spark, str(tmp_path / "out"), str(tmp_path / "check"), 10)
    rotation.add(feed(spark, 0, 25), 0)
    rotation.add(feed(spark, 0, 25), 0)
    assert every_line(rotation) == list(range(25))
    assert rotation.open.committed() == 0


def test_killed_batch_lands_once(spark, tmp_path, monkeypatch):
    """Files are written, the commit is not: the next attempt replaces them."""
    source = tmp_path / "feed"
    add_file(source, "a", 0, 25)
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    rotation = Rotation(spark, target, checkpoint, 10)
    rotate(feed_stream(spark, str(source)), rotation, checkpoint).awaitTermination()
    add_file(source, "b", 25, 48)
    write = Rotation._write

    def dies(self, placed):
        write(self, placed)
        raise RuntimeError("killed")

    monkeypatch.setattr(Rotation, "_write", dies)
    with pytest.raises(Exception, match="killed"):
        rotate(feed_stream(spark, str(source)), rotation, checkpoint).awaitTermination()
    assert rotation.open.committed() == 0
    monkeypatch.setattr(Rotation, "_write", write)
    rotate(feed_stream(spark, str(source)), rotation, checkpoint).awaitTermination()
    assert sizes(rotation) == {0: 10, 1: 10, 2: 10, 3: 10}
    assert every_line(rotation) == list(range(48))
    rotation.close()
    assert sizes(rotation) == {0: 10, 1: 10, 2: 10, 3: 10, 4: 8}


def test_state_does_not_grow(spark, tmp_path):
    """One table of waiting lines, and landed files leave the source."""
    source, archive = tmp_path / "feed", tmp_path / "archive"
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    rotation = Rotation(spark, target, checkpoint, 5)
    for n in range(4):
        add_file(source, f"f{n}", n * 7, n * 7 + 7)
        stream = feed_stream(spark, str(source), archive=str(archive))
        rotate(stream, rotation, checkpoint).awaitTermination()
        assert len(folders(spark, rotation.open.folder)) == 1
        assert rotation.open_lines().count() < 5
    assert every_line(rotation) == list(range(28))
    assert len(list(source.iterdir())) < 4
    assert [path for path in archive.rglob("f*") if path.is_file()]


def test_lines_of_any_kind(spark, tmp_path):
    rotation = Rotation(spark, str(tmp_path / "out"), str(tmp_path / "check"), 2)
    lines = ["", '{"broken', "é\t", "x", "x"]
    frame = spark.createDataFrame([(v,) for v in [*lines, None]], "value STRING")
    rotation.add(frame, 0)
    found = [v for _, v in rows(rotation.files())] + [v for _, v in rows(rotation.open_lines())]
    assert sorted(found) == sorted(lines)
    with pytest.raises(ValueError, match="at least one"):
        Rotation(spark, "a", "b", 10, 11)
