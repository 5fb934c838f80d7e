import __spark_entry__


def test_every_numbered_operator_is_registered_once():
    numbers = [int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(numbers) == list(range(1, 14))
