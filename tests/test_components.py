"""Connected blobs that cross the strips in which they are found."""

from hexdrift.plans import coverage


def test_blobs_across_strips(spark, monkeypatch):
    """A snake over many strips, a blob within one, two that end at a strip's border; rounds are over parts alone."""
    # Columns 0 to 8 of rows 0 to 29, joined at alternate ends; the path goes up and down through all strips.
    snake = {r * 50 + q for q in range(0, 9, 2) for r in range(30)} | {(29 if q % 4 == 0 else 0) * 50 + q + 1 for q in range(0, 8, 2)}
    rest = {30 * 50 + 20, 31 * 50 + 20, 32 * 50 + 30, 40 * 50 + 20, 40 * 50 + 21}
    rows = [(p, "A", c) for p in (0, 1) for c in sorted(snake | rest)]
    cells, seen, before = spark.createDataFrame(rows, "provider_id int, technology string, cell long"), [], coverage._propagated
    monkeypatch.setattr(coverage, "STRIP", 4)
    monkeypatch.setattr(coverage, "_propagated", lambda nodes, edges: seen.append(nodes.count()) or before(nodes, edges))
    got = {(r.provider_id, r.cell): r.label for r in coverage.components(cells).collect()}

    def least(c, own):
        new, held = {c}, set()
        while new:
            held |= new
            new = {n for x in new for q, r in [(x % 50, x // 50)] for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)) if 0 <= q + a < 50 for n in [(r + b) * 50 + q + a] if n in own} - held
        return min(held)

    assert got == {(p, c): least(c, snake | rest) for p, _, c in rows}
    assert 0 < seen[0] < len(rows) / 2
