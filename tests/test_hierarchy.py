from tallyforge.operators.hierarchy import Row, Solver, arithmetic_ok, checks_of, solve_tables


def table(*rows):
    return [Row(lab, nums, ["empty" if n is None else "number" for n in nums], ind) for lab, nums, ind in rows]


def test_parent_before_parts():
    rows = table(("current", [30.0, 3.0], 0), ("a", [10.0, 1.0], 1), ("b", [20.0, 2.0], 1), ("total", [30.0, 3.0], 0))
    checks = Solver(rows).solve()
    assert [(c.relation, c.parent, c.parts, c.passed) for c in checks][:2] == [("sum_of_following", 0, [1, 2], True)] * 2
    assert rows[1].parent == 0 and rows[0].row_type == "parent"


def test_total_after_parts_and_tolerance():
    rows = table(("sales", [100.0], 0), ("cost", [-60.0], 0), ("gross", [41.0], 0))
    checks = Solver(rows).solve()
    assert [(c.relation, c.parent, c.parts) for c in checks] == [("sum_of_preceding", 2, [0, 1])]
    assert checks[0].passed and checks[0].expected - checks[0].computed == 1


def test_single_component_then_total():
    rows = table(("open", [5.0], 0), ("buy", [7.0], 0), ("close", [12.0], 0), ("net", [12.0], 0))
    relations = [c.relation for c in Solver(rows).solve()]
    assert relations == ["single_component", "sum_of_preceding"]
    assert rows[2].children == [3, 0, 1]


def test_unconfirmed_link_fails():
    rows = table(("p", [100.0], 0), ("a", [30.0], 1), ("b", [44.0], 1))
    (c,) = Solver(rows).solve()
    assert c.relation == "sum_of_following_unconfirmed" and not c.passed


def test_empty_zero_and_unlabelled():
    rows = table(("head", [None], 0), ("zero", [0.0], 0), ("", [5.0], 0), ("x", [5.0], 0))
    Solver(rows).solve()
    assert rows[0].row_type == "section_header" and rows[1].vector is None and rows[2].children == [3]
    assert Solver([]).solve() == []


def test_grouped(spark):
    data = [(1, i, lab, nums, ["number"] * len(nums), 0, False) for i, (lab, nums) in enumerate([("a", [1.0, 2.0]), ("b", [3.0, 4.0]), ("t", [4.0, 6.0])])]
    data += [(2, 0, "only", [1.0], ["number"], 0, False)]
    df = spark.createDataFrame(data, "t int, row_idx int, label string, nums array<double>, kinds array<string>, indent int, decimal boolean")
    solved = solve_tables(df, ["t"]).cache()
    assert solved.count() == 4
    checks = checks_of(solved, ["t"])
    assert {(r["column"], tuple(r["component_rows"]), r["passed"]) for r in checks.collect()} == {(0, (0, 1), True), (1, (0, 1), True)}
    assert arithmetic_ok(checks, ["t"]).where("arithmetic_ok").count() == 6
