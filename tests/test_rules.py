import pytest

from smallseq import rules as R


@pytest.mark.parametrize(("text", "want"), [("", None), ("All", None), ("19", [19]), ("19, 21-23", [19, 21, 22, 23]), (" 25 - 26 ", [25, 26])])
def test_numbers(text, want):
    assert R.parse_numbers(text) == want


@pytest.mark.parametrize("text", ["a", "1-", "1,,2", "-3"])
def test_bad_numbers(text):
    with pytest.raises(ValueError):
        R.parse_numbers(text)


@pytest.mark.parametrize(("text", "want"), [("*", None), ("A,u", ["A", "T"]), ("n", ["N"])])
def test_nucleotides(text, want):
    assert R.parse_nts(text) == want


@pytest.mark.parametrize("text", ["A,", "X", "A B"])
def test_bad_nucleotides(text):
    with pytest.raises(ValueError):
        R.parse_nts(text)


@pytest.mark.parametrize(("text", "want"), [("sense", True), (" Antisense ", False), ("both", None)])
def test_strand(text, want):
    assert R.parse_strand(text) is want


def test_bad_strand():
    with pytest.raises(ValueError):
        R.parse_strand("+")


@pytest.mark.parametrize(
    ("text", "want"),
    [("full", ("nested", False, 0, 0)), ("5' anchored, -3, 2", ("5' anchored", False, -3, 2)), ("any, x", ("partial", True, 0, 0)), ("exact", ("exact", False, 0, 0)), ("", ("partial", True, 0, 0))],
)
def test_overlap(text, want):
    assert R.parse_overlap(text) == want


@pytest.mark.parametrize("text", ["inside", "nested, 1", "nested, a, b", "exact, 1, 2, 3"])
def test_bad_overlap(text):
    with pytest.raises(ValueError):
        R.parse_overlap(text)


def test_duplicates_ignore_the_hierarchy():
    sheet = [R.Rule("class", "x", hierarchy=1), R.Rule("Class", "X", hierarchy=2), R.Rule("class", "y")]
    assert [i for i, _ in R.unique_rules(sheet)] == [0, 2]


def test_typed_table(spark):
    row = R.rule_table(spark, [R.Rule("Class", "CSR", "c", source="A, ,b", nt5="a,U", length="20-21")]).first()
    assert (row["key"], row["val"], row["sources"], row["nts"], row["lengths"]) == ("class", "csr", ["a", "b"], ["A", "T"], [20, 21])
