import pytest

from recordloom.llm import edits
from recordloom.llm import names as N

SAME = [
    ["University of Kenaduzanu", "UNIVERSITY OF KENADUZANU", "U. of Kenaduzanu", "Univ. of Kenaduzanu", "Kenaduzanu University", "Kenaduzanu, University of", "The University of Kenaduzanu", "University of Kennaduzanu"],
    ["Rorukopeti Institute of Machine Intelligence", "Rorukopeti Inst. Mach. Intell.", "IMI, Rorukopeti", "Rorukopeti Institute for Machine Intelligence (IMI)", "Rorukopeti IMI", "Institute of Machine Intelligence Rorukopeti"],
    ["Kasevesozo Labs", "kasevesozo-labs", "KasevesozoLabs", "Kasevesozo Labs, Inc.", "Kasevesozo Laboratories", "Kasevesozo", "Kasevseozo Labs"],
    ["Penefifaha AI Research", "PenefifahaAI", "Penefifaha A.I. Res.", "Penefifaha AI Research GmbH", "AI Research at Penefifaha", "Penefifaha Artificial Intelligence Research"],
    ["Elizabeth Lorokagile Research Trust", "Liz Lorokagile Research Trust", "E. Lorokagile Research Trust", "Lorokagile, Elizabeth, Research Trust", "Lorokagile Research Trust", "Elizabeth Lorokagile Trust"],
    ["Kenaduzanu Labs"], ["Alexander Kasevesozo Research Trust"], ["Frederick Kasevesozo Research Trust"], ["Kasevesozo Research Trust"], ["K. Kasevesozo Research Trust"],
]
FAMILIES = [["Jitufazizi", "jitufazizi", "JitufaziziLM", "Jitufazizi series", "the Jitufazizi models", "Jitufazizi-LM", "Jitu-fazizi", "JituFazizi", "Jitufazzizi"], ["Open Jitufazizi", "OpenJitufazizi", "Jitufazizi (Open)", "open-jitufazizi", "Open Jitufazizi model family"], ["Jitufazizi Coder", "Coder Jitufazizi", "JITUFAZIZI-CODER"], ["Jitufazizi Math"]]


def test_entities(spark):
    rows = [("organization", n, 1.0 + (i == 0)) for g in SAME for i, n in enumerate(g)] + [("model_family", n, 1.0 + (i == 0)) for g in FAMILIES for i, n in enumerate(g)]
    got = {r.name: r.entity for r in N.entities(spark.createDataFrame(rows, "field_name string, name string, n double")).collect()}
    for g in SAME + FAMILIES:
        assert len({got[n] for n in g}) == 1, {n: got[n] for n in g}
    assert len({got[g[0]] for g in SAME}) == len(SAME) and len({got[g[0]] for g in FAMILIES}) == len(FAMILIES)


def test_rewritings_of_any_name(spark):
    """Given names with any kind of body, unknown given names, parts in any order, nicknames of several names."""
    same = [
        ["Marie Curie University", "University of Marie Curie", "M. Curie University", "Curie, Marie, University"], ["Theodore Balimo Labs", "Theo Balimo Labs", "T. Balimo Labs", "Balimo, Theodore, Inc."],
        ["Gonzo Zadofa Labs", "Zadofa Gonzo Laboratories", "Zadofa, Gonzo"], ["Frederick Molidu Trust", "Rick Molidu Trust"], ["Richard Kepalo Institute", "Rick Kepalo Institute"],
    ]
    apart = ["Edward Sunoti Trust", "Theodore Sunoti Trust", "Ted Sunoti Trust"]  # Ted is either
    rows = [("organization", n, 1.0 + (i == 0)) for g in same for i, n in enumerate(g)] + [("organization", n, 1.0) for n in apart]
    got = {r.name: (r.entity, r.rarity) for r in N.entities(spark.createDataFrame(rows, "field_name string, name string, n double")).collect()}
    for g in same:
        assert len({got[n][0] for n in g}) == 1, {n: got[n] for n in g}
    assert len({got[n][0] for n in apart}) == 3 and len({got[g[0]][0] for g in same}) == len(same)


def test_forms_against_brute_force():
    """Two names are led together exactly if one of them can be rewritten to the other by the stated rules."""
    import itertools

    for parts in (["ab"], ["ab", "cd"], ["ab", "cd", "ef"]):
        assert set(N._orders(parts)) == {"".join(x) for x in itertools.permutations(parts)}
    assert N.organization_form("Rick Molidu Research Trust")[:3] == ("trust", ["frederick", "richard"], ["molidu"])
    assert N.organization_form("Dalome Lab. of Artif. Intell.")[0] == "labs" and N.organization_form("IMI Dalome")[0] == "institute" and N.organization_form("U. Dalome")[0] == "university"


def test_pairs_are_ordered_and_complete(spark):
    rows = [("organization", n, 1.0) for n in SAME[0]]
    pairs = {(r.name_1, r.name_2) for r in N.variant_pairs(N.entities(spark.createDataFrame(rows, "field_name string, name string, n double"))).collect()}
    assert len(pairs) == len(SAME[0]) * (len(SAME[0]) - 1) // 2 and all(a < b for a, b in pairs)


def test_lists_nulls_and_empty(spark):
    rows = [(i, "Kasevesozo Labs", None, "c") for i in range(40)] + [(100 + i, "Bolageta Labs; Kasevesozo Labs", "n/a", "c") for i in range(3)] + [(200, None, None, "c"), (201, "", "Jitufazizi", "c"), (202, "()", "—", "c")]
    df = spark.createDataFrame(rows, "prop_id long, organization string, model_family string, stem string")
    assert {(r.field_name, r.name) for r in N.single_names(df, "prop_id").collect()} == {("organization", "Kasevesozo Labs"), ("model_family", "Jitufazizi")}
    assert N.entities(N.single_names(df.limit(0), "prop_id")).count() == 0


@pytest.mark.parametrize(("a", "b", "near"), [("losekikino", "losekiknio", True), ("losekikino", "losekkino", True), ("losekikino", "losekixino", True), ("losekikino", "losekikkino", True), ("losekikino", "lasekikono", False), ("abcde", "abcdf", False)])
def test_edits(spark, a, b, near):
    df = spark.createDataFrame([("s", a, 3.0), ("s", b, 1.0)], "scope string, stem string, n double")
    got = {r.stem: r.canonical for r in edits.canonical_stems(df, ["scope"]).collect()}
    assert got == {a: a, b: a if near else b}
