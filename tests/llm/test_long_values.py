"""The secret scan without a bound on the parts of a value (round 3)."""

from aerolith.llm import secret_scan


def _named(text):
    return [text[s["start"]:s["end"]] for s in secret_scan.secrets_of(text) if s["kind"] == "named"]


def test_values_of_many_atoms():
    """no bound on the atoms of a value or on the literals that a name stands for."""
    atoms = [f"{c}7xQ" for c in "abcdefghijklmnopqrstuvwxyz"]
    assert _named("pwd = " + " + ".join(f'"{a}"' for a in atoms)) == atoms
    lines = [f'p{i} = p{i - 1} + "{a}"' if i else f'p0 = "{a}"' for i, a in enumerate(atoms)]
    assert _named("\n".join([*lines, "signing_key = p25"])) == atoms
    front = [f'p{i} = "{a}" + p{i - 1}' if i else f'p0 = "{a}"' for i, a in enumerate(atoms)]
    assert _named("\n".join([*front, "signing_key = p25 + p3"])) == atoms
    assert len(_named("".join(f'pwd = "x{i}Qz" + pwd\n' for i in range(3000)))) >= 2999
