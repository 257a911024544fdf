"""Logs read while they are written: half lines, rotation, line counts, restarts."""

import os

import pytest

from realmwatch.sources.growing import GrowingFolder, part_lines, scan_growing
from realmwatch.streaming.incremental import catch_up


def append(path, data):
    with open(path, "ab") as out:
        out.write(data)


def lines_of(stops):
    return [f"2024-01-01T00:00:{k:02d} line {k} {'x' * (k % 7)}" for k in stops]


@pytest.fixture
def stream(spark, tmp_path):
    """Run a stream over the folder to its present end; gives the batches of new lines."""
    folder = tmp_path / "logs"
    folder.mkdir()

    def run(**options):
        got = []
        query = (
            scan_growing(spark, str(folder), **options)
            .writeStream.foreachBatch(lambda df, n: got.append([r.value for r in df.collect()]))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(processingTime="0 seconds")
            .start()
        )
        catch_up(query)
        return [sorted(b) for b in got if b]

    return folder, run


def test_a_line_written_in_two_is_read_once(stream):
    folder, run = stream
    text = ("\n".join(lines_of(range(10))) + "\n").encode()
    append(folder / "kdc.log", text[:100])
    first = run()
    whole = text[:100].decode().split("\n")[:-1]
    assert first == [sorted(whole)]
    append(folder / "kdc.log", text[100:])
    assert run() == [sorted(set(lines_of(range(10))) - set(whole))]
    assert run() == []


def test_renamed_files_are_read_on(stream):
    folder, run = stream
    append(folder / "kdc.log", "\n".join(lines_of(range(5))).encode() + b"\nhalf")
    assert sum(run(), []) == lines_of(range(5))
    append(folder / "kdc.log", b" done\nno end")
    os.rename(folder / "kdc.log", folder / "kdc.log.1")
    assert run() == [["half done"]]
    append(folder / "kdc.log", "\n".join(lines_of(range(20, 25))).encode() + b"\n")
    # the next file has a line, so the last one of the old file is as whole as it will be
    assert sum(run(), []) == sorted(lines_of(range(20, 25)) + ["no end"])
    os.rename(folder / "kdc.log.1", folder / "kdc.log.2")
    os.rename(folder / "kdc.log", folder / "kdc.log.1")
    assert run() == []


def test_a_log_copied_and_cut_to_nothing(stream):
    folder, run = stream
    text = ("\n".join(lines_of(range(8))) + "\n").encode()
    append(folder / "kdc.log", text)
    assert sum(run(), []) == lines_of(range(8))
    append(folder / "kdc.log", b"late\n")
    (folder / "kdc.log-20240131").write_bytes((folder / "kdc.log").read_bytes())
    (folder / "kdc.log").write_bytes(b"")
    assert run() == [["late"]]
    append(folder / "kdc.log", b"new\n")
    assert run() == [["new"]]


def test_batches_of_so_many_lines(stream):
    folder, run = stream
    append(folder / "a.log", ("\n".join(lines_of(range(25))) + "\n").encode())
    append(folder / "b.log", ("\n".join(lines_of(range(30, 33))) + "\n").encode())
    batches = run(lines_per_batch=10)
    assert [len(b) for b in batches] == [10, 10, 8]
    assert sorted(sum(batches, [])) == sorted(lines_of(range(25)) + lines_of(range(30, 33)))
    # a stream that starts again goes on in batches of the same size
    append(folder / "a.log", ("\n".join(lines_of(range(40, 55))) + "\n").encode())
    assert [len(b) for b in run(lines_per_batch=10)] == [10, 5]


def test_a_restart_repeats_the_batch_that_failed(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    append(folder / "kdc.log", ("\n".join(lines_of(range(12))) + "\n").encode())
    got = {}

    def start(fails_at):
        def take(df, number):
            rows = sorted(r.value for r in df.collect())
            if number == fails_at:
                raise RuntimeError("lost")
            got.setdefault(number, []).append(rows)

        writer = scan_growing(spark, str(folder), lines_per_batch=5).writeStream.foreachBatch(take)
        writer = writer.option("checkpointLocation", str(tmp_path / "checkpoint"))
        return writer.trigger(processingTime="0 seconds").start()

    with pytest.raises(Exception, match="lost"):
        catch_up(start(fails_at=1))
    os.rename(folder / "kdc.log", folder / "kdc.log.1")  # between failure and restart
    query = start(fails_at=None)
    catch_up(query)
    assert [len(got[k]) for k in sorted(got) if got[k][0]] == [1, 1, 1]
    assert [len(got[k][0]) for k in sorted(got) if got[k][0]] == [5, 5, 2]
    assert sorted(sum((g[0] for g in got.values()), [])) == lines_of(range(12))
    assert str(os.path.getsize(folder / "kdc.log.1")) in str(query.lastProgress.sources[0].endOffset)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20, 64, 1000])
def test_parts_hold_every_line_once(tmp_path, size):
    body = b"a\n\nbb\nccc ccc ccc ccc\n" * 9 + b"\n" + b"d" * 70 + b"\nlast"
    (tmp_path / "kdc.log.1").write_bytes(body)
    (tmp_path / "kdc.log").write_bytes(b"next\n")
    folder = GrowingFolder({"path": str(tmp_path), "partitionBytes": str(size)})
    (identity,) = [i for i, f in folder.files().items() if f.name == "kdc.log.1"]
    end = folder.ends({})
    assert end[identity] == len(body)
    for begin in (0, 2, 3, 22):
        got = []
        for part in folder.parts({identity: begin}, {identity: end[identity]}):
            got += part_lines(folder.open(part[0], part[1]), *part[2:])
        assert got == body[begin:].split(b"\n")


def test_lost_files(spark, tmp_path):
    (tmp_path / "kdc.log").write_bytes(b"one\ntwo\n")
    strict, loose = (GrowingFolder({"path": str(tmp_path), "failOnDataLoss": x}) for x in ("true", "false"))
    end = strict.ends({})
    os.remove(tmp_path / "kdc.log")
    with pytest.raises(RuntimeError, match="failOnDataLoss"):
        strict.parts({}, end)
    assert loose.parts({}, end) == [] and loose.ends(end) == {}
    (identity,) = end
    assert loose.open(identity, str(tmp_path / "kdc.log")) is None
    for bad in ({}, {"path": "x", "linesPerBatch": "0"}):
        with pytest.raises(ValueError):
            GrowingFolder(bad)


def test_odd_bytes_and_names(stream):
    folder, run = stream
    append(folder / "kdc.log", b"windows\r\n\xff\xfe bytes\n\ngr\xc3\xbc\xc3\x9fe\n")
    append(folder / ".hidden", b"no\n")
    append(folder / "other.txt", b"no\n")
    assert run(glob="*.log") == [sorted(["windows", "�� bytes", "", "grüße"])]


def deal(folder, start, end):
    """The lines of each batch between two positions, read by its tasks."""
    got = {}
    for number, parts in folder.tasks(start, end):
        for part in parts:
            got.setdefault(number, []).extend(part_lines(folder.open(part[0], part[1]), *part[2:]))
    return [got[k] for k in sorted(got)]


@pytest.mark.parametrize("size", [20, 1 << 20])
def test_batches_side_by_side(tmp_path, size):
    """Up to five batches of seven lines a micro-batch; a replay cuts them alike, whatever came since."""
    bodies = {"a.log": 60, "b.log": 3, "c.log": 41}
    for name, lines in bodies.items():
        append(tmp_path / name, b"".join(b"%s %d %s\n" % (name.encode(), k, b"x" * (k % 9)) for k in range(lines)))
    append(tmp_path / "a.log", b"half")
    options = {"path": str(tmp_path), "linesPerBatch": "7", "batchesPerTrigger": "5", "partitionBytes": str(size)}
    folder, at, steps = GrowingFolder(options), {}, []
    while (end := folder.ends(at)) != at:
        steps.append((at, end, deal(folder, at, end)))
        at = end
    sizes = [[len(b) for b in batches] for _, _, batches in steps]
    assert sizes == [[7] * 5, [7] * 5, [7, 7, 7, 7, 6]]
    whole = [line for _, _, batches in steps for b in batches for line in b]
    assert sorted(whole) == sorted(
        line for n in bodies for line in (tmp_path / n).read_bytes().split(b"\n")[:-1]
    )
    assert len({line[:1] for b in steps[0][2] for line in b}) == 3  # dealt evenly: no file waits for another
    append(tmp_path / "a.log", b" done\nno end")
    os.rename(tmp_path / "a.log", tmp_path / "a.log.1")
    append(tmp_path / "a.log", b"next\n")
    append(tmp_path / "aa.log", b"another\n")
    for start, end, batches in steps:
        assert deal(GrowingFolder(options), start, end) == batches
    assert sorted(sum(deal(folder, at, folder.ends(at)), [])) == [b"another", b"half done", b"next", b"no end"]
    for bad in ({"batchesPerTrigger": "2"}, {"batchesPerTrigger": "0", "linesPerBatch": "1"}):
        with pytest.raises(ValueError):
            GrowingFolder({"path": "x", **bad})


def test_a_stream_takes_waiting_batches_at_once(spark, tmp_path):
    folder, got = tmp_path / "logs", []
    folder.mkdir()

    def run():
        query = (
            scan_growing(spark, str(folder), lines_per_batch=10, batches_per_trigger=4)
            .writeStream.foreachBatch(lambda df, n: got.append(df.collect()))
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="0 seconds").start()
        )
        catch_up(query)
        sizes = [[len([r for r in rows if r.batch == k]) for k in range(4)] for rows in got if rows]
        lines = sorted(r.value for rows in got for r in rows)
        got.clear()
        return sizes, lines

    append(folder / "a.log", ("\n".join(lines_of(range(55))) + "\n").encode())
    append(folder / "b.log", ("\n".join(lines_of(range(60, 63))) + "\n").encode())
    sizes, lines = run()
    assert sizes == [[10] * 4, [10, 8, 0, 0]]
    assert lines == sorted(lines_of([*range(55), *range(60, 63)]))
    append(folder / "a.log", ("\n".join(lines_of(range(70, 82))) + "\n").encode())
    assert run() == ([[10, 2, 0, 0]], lines_of(range(70, 82)))
