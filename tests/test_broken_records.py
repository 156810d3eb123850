"""Records cut by a line break inside quotes, found again across splits."""
import random

import pytest

from traitflow.sources import lines as LN


def by_hand(lines):
    """(record, part) of each line, and the texts of the records of several lines."""
    out, record, is_open, texts = [], -1, False, {}
    for line in lines:
        turns = line.count('"') % 2 == 1
        if not is_open:
            record += 1
        goes_on, is_open = is_open, is_open != turns
        out.append((record, ("last", "inside")[is_open] if goes_on else ("whole", "first")[is_open]))
        texts.setdefault(record, []).append(line)
    broken = {r: t for r, t in texts.items() if any(x[0] == r and x[1] != "whole" for x in out)}
    closed = {r: any(x == (r, "last") for x in out) for r in broken}
    return out, sorted((r, len(t) if closed[r] else 1, "\n".join(t) if closed[r] else t[0]) for r, t in broken.items())


def some_lines(rng, n):
    return [rng.choice(['a\tb\tc', 'x\t"open', 'closes"\ty', 'a "quoted" field', '', 'plain', '"""', 'é" ü', 'long ' * rng.randrange(20)]) for _ in range(n)]


@pytest.mark.parametrize("split", [40, 97, 1 << 20])
def test_parity_is_carried_over_splits(spark, tmp_path, split):
    rng, files = random.Random(split), {}
    for name in "abc":
        files[name] = some_lines(rng, 60)
        (tmp_path / f"{name}.txt").write_text("\n".join(files[name]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(before, (split, 1)):
        spark.conf.set(k, v)
    try:
        read = LN.read_placed_lines(spark, str(tmp_path))
        assert split > 1000 or read.select("file_path", "block").distinct().count() > 9
        placed = LN.placed_records(read)
        rows = placed.orderBy("file_path", "block", "place").collect()
        broken = LN.broken_records(placed).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, lines in files.items():
        mine = [r for r in rows if r.file_path.endswith(f"{name}.txt")]
        assert [r.value for r in mine] == lines
        parts, records = by_hand(lines)
        assert [(r.record, r.part) for r in mine] == parts
        assert sorted((r.record, r.n_lines, r.text) for r in broken if r.file_path.endswith(f"{name}.txt")) == records


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    placed = LN.placed_records(LN.read_placed_lines(spark, str(tmp_path)))
    assert placed.count() == 0 and LN.broken_records(placed).count() == 0
