"""Operators on small inputs whose results are written out here."""

import json
import sqlite3

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from claimloom.functions import text as T
from claimloom.functions.identity import stable_id
from claimloom.operators import agreement, chunking, confidence, matching, merge, normalize, reconcile, reports, validate
from claimloom.sources import graphs, ontology, ris, sqlite_manifest
from claimloom.streaming import incremental


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).head()["x"]


def test_text_functions(spark):
    assert one(spark, T.fold(F.col("v")), v="  Direct-Causal (claim) ") == "direct_causal_claim"
    assert one(spark, T.norm(F.col("v")), v=" Soil \n Salinity ") == "soil salinity"
    assert sorted(one(spark, T.tokens(F.col("v")), v="Salinity of the Soil")) == ["salinity", "soil"]
    assert one(spark, T.clean_text(F.col("v")), v="A <i>Culex</i>  study") == "A Culex study"
    assert one(spark, T.parse_year(F.col("v")), v="2008///") == 2008
    assert one(spark, T.parse_doi(F.col("v")), v="doi: 10.1000/ABC.9).") == "10.1000/abc.9"
    assert one(spark, T.slugify(F.col("v")), v="Müller & Søn: Éco") == "muller_sn_eco"
    assert one(spark, T.slugify(F.col("v")), v="!!!") == "document"
    assert one(spark, T.backoff_tails(F.col("v")), v="a b c d e") == ["b c d e", "c d e", "d e"]
    assert one(spark, T.backoff_tails(F.col("v")), v="a") == []
    assert one(spark, T.label_variants(F.col("v")), v="grubbing process") == ["grubbing process", "grubbing"]
    assert one(spark, T.looks_like_identifier(F.col("v")), v=" ENVO:001 ") and not one(spark, T.looks_like_identifier(F.col("v")), v="soil salinity")
    assert one(spark, T.label_similarity(F.col("a"), F.col("b")), a="grubbing", b="grubbing process") == 1.0
    assert one(spark, T.word_count(F.col("v")), v="  a  b\nc ") == 3
    assert one(spark, T.local_path(F.col("v")), v="internal-pdf://12/a%20b.pdf") == "12/a b.pdf"
    assert one(spark, T.local_path(F.col("v")), v="http://x/a.pdf") is None
    parts = one(spark, T.filename_parts(F.col("v")), v="Smith and Jones, et al. - 1999 - On <b>Things</b>")
    assert (parts["authors"], parts["year"], parts["title"]) == (["Smith", "Jones"], 1999, "On Things")


def test_attribute_similarity(spark):
    score = T.containment_score(T.plain_tokens(F.col("a")), T.plain_tokens(F.col("b")))
    assert one(spark, score, a="larval abundance", b="mosquito larval abundance") == pytest.approx(0.9)
    assert one(spark, score, a="larval abundance", b="abundance of larvae") == pytest.approx(0.45)
    assert one(spark, score, a="", b="x") == 0.0


def test_json_object(spark):
    assert one(spark, T.json_object(F.col("v")), v='<think>{"no": 1}</think>```json\n{"a": 1}\n```') == '{"a": 1}'
    assert json.loads(one(spark, T.json_object(F.col("v")), v='Sure: {"a": {"b": 2}} ok')) == {"a": {"b": 2}}
    assert one(spark, T.json_object(F.col("v")), v="nothing") is None


def test_stable_id(spark):
    import hashlib

    expected = "camo:edge_" + hashlib.sha256(b"a||b").hexdigest()[:12]
    assert one(spark, stable_id("camo:edge_", F.col("x"), F.lit(None), F.col("y")), x="a", y="b") == expected


NODE = "graph_ord int, item_ord int, node string, entity_term string, measured_attribute string, qualifier string, entity_type string, name string"


def _nodes(spark):
    rows = [(0, 0, "n1", "Culex", "abundance", "increased", "taxon", ""), (1, 0, "n1", "culex ", "Abundance", "increased", "taxon", "Mosquitoes"), (1, 1, "n2", "salinity", "", "present", "environmental_variable", None)]
    return spark.createDataFrame(rows, NODE)


def test_merge_nodes_fills_and_maps(spark):
    merged, id_map = merge.merge_nodes(_nodes(spark), ["entity_term", "measured_attribute", "qualifier", "entity_type"], ["name", "entity_term"])
    rows = {r["entity_term"]: r for r in merged.collect()}
    assert len(rows) == 2 and rows["Culex"]["name"] == "Mosquitoes" and rows["Culex"]["sources"] == 2
    ids = {(r["graph_ord"], r["old_id"]): r["new_id"] for r in id_map.collect()}
    assert ids[0, "n1"] == ids[1, "n1"] != ids[1, "n2"]


def test_merge_is_idempotent(spark):
    facets = ["entity_term", "measured_attribute", "qualifier", "entity_type"]
    once, _ = merge.merge_nodes(_nodes(spark), facets, [*facets, "name"])
    again, _ = merge.merge_nodes(once.select(F.lit(0).alias("graph_ord"), F.row_number().over(Window.orderBy("new_id")).alias("item_ord"), F.col("new_id").alias("node"), *facets, "name"), facets, [*facets, "name"])
    key = lambda df: sorted(tuple(r) for r in df.select("new_id", *facets, "name").collect())
    assert key(once) == key(again)


def test_edges_rewrite_and_dedup(spark):
    edges = spark.createDataFrame(
        [(0, 0, "e1", "n1", "n2", "causes", "It rises.", "d", None), (1, 0, "e1", "m1", "m2", "causes", "it  RISES.", "d", "direct_causal"), (1, 1, "e2", "m1", "m1", "causes", None, "d", None)],
        "graph_ord int, item_ord int, edge string, subject string, object string, predicate string, original_sentence string, source_document string, claim_strength string",
    )
    id_map = spark.createDataFrame([(0, "n1", "A"), (0, "n2", "B"), (1, "m1", "A"), (1, "m2", "B")], "graph_ord int, old_id string, new_id string")
    merged, edge_map = merge.merge_edges(merge.rewrite(edges, id_map, ["subject", "object"]), ["claim_strength"])
    rows = {(r["subject"], r["object"]): r for r in merged.collect()}
    assert rows["A", "B"]["sources"] == 2 and rows["A", "B"]["claim_strength"] == "direct_causal" and rows["A", "B"]["original_sentence"] == "It rises."
    assert ("A", "A") in rows and edge_map.count() == 3


def test_rewrite_list_keeps_order(spark):
    df = spark.createDataFrame([(0, 1, ["c", "a", "zz"])], "graph_ord int, item_ord int, refs array<string>")
    id_map = spark.createDataFrame([(0, "a", "A"), (0, "c", "C")], "graph_ord int, old_id string, new_id string")
    assert merge.rewrite_list(df, id_map, "refs", ["graph_ord", "item_ord"]).head()["refs"] == ["C", "A", "zz"]


def test_unique_slugs_pass_over_natural_suffixes(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x_2"), (4, "x")], "ord int, slug string")
    rows = merge.unique_slugs(df, "slug", ["ord"]).orderBy("ord").collect()
    assert [r["slug"] for r in rows] == ["x", "x_3", "x_2", "x_4"]


def test_unique_slugs_cost_no_more_in_long_groups(spark, capsys):
    natural = [(i, f"x_{n}") for i, n in enumerate((3, 4, 7, 99))]
    df = spark.createDataFrame([*natural, *[(10 + i, "x") for i in range(300)]], "ord int, slug string")
    found = merge.unique_slugs(df, "slug", ["ord"])
    free = (n for n in range(2, 400) if n not in (3, 4, 7, 99))
    assert [r["slug"] for r in found.where("ord >= 10").orderBy("ord").collect()] == ["x", *[f"x_{next(free)}" for _ in range(299)]]
    found.explain()
    assert "sequence(" not in capsys.readouterr().out  # an array as long as the row's number makes a group quadratic


NODES = "id string, ord int, entity_term string, measured_attribute string, qualifier string, entity_type string"


def test_reconcile_rules(spark):
    existing = spark.createDataFrame([("e1", 1, "ENVO:1", "larval abundance", "increased", "taxon"), ("e2", 2, "ENVO:1", "larval abundance", "decreased", "taxon"), ("e3", 3, "Culex", "", "present", "taxon"), ("e4", 4, "culex", "", "present", "taxon")], NODES)
    new = spark.createDataFrame([("a", 1, "envo:1", "Larval  abundance", "increased", "taxon"), ("b", 2, "ENVO:1", "mosquito larval abundance", "decreased", "taxon"), ("c", 3, "culex", "rate", "present", "taxon"), ("d", 4, "ENVO:1", "larval abundance", "removed", "taxon"), ("f", 5, "Culex", "", "present", "taxon")], NODES)
    found = {r["new_id"]: (r["existing_id"], r["rule"], r["score"]) for r in reconcile.reconcile(new, existing).collect()}
    assert found == {"a": ("e1", "identity", 1.0), "b": ("e2", "grounded", 0.9), "c": ("e3", "lexical", 0.7), "f": ("e4", "identity", 1.0)}


def test_enum_coercion(spark):
    permitted = spark.createDataFrame([("direct_causal", 0), ("associational", 1), ("no_relationship", 2)], "name string, ord int")
    aliases = spark.createDataFrame([("correlation", "associational"), ("x", "not_permitted")], "alias string, name string")
    values = spark.createDataFrame([("direct_causal",), ("Direct causal",), ("Correlation",), ("direct causal relationship",), ("x",), (None,)], "value string")
    found = {r["value"]: (r["coerced"], r["how"]) for r in normalize.coerce_enum(values, permitted, aliases).collect()}
    assert found == {"direct_causal": ("direct_causal", "exact"), "Direct causal": ("direct_causal", "case/punctuation"), "Correlation": ("associational", "curated alias"), "direct causal relationship": ("direct_causal", "token overlap"), "x": (None, None)}


def test_endpoints_and_integrity(spark):
    nodes = spark.createDataFrame([(0, 0, "n1", "I1", "Rain"), (0, 1, "n1", "I2", "Flood")], "graph_ord int, item_ord int, raw_id string, id string, name string")
    edges = spark.createDataFrame([(0, "e", "n1", "Rain"), (0, "e", "I1", "gone")], "graph_ord int, id string, subject string, object string")
    resolved = normalize.resolve_endpoints(edges, nodes, ["subject", "object"])
    assert sorted((r["subject"], r["object"]) for r in resolved.collect()) == [("I1", "gone"), ("I2", "I1")]
    kept, dropped = normalize.drop_dangling(resolved, nodes)
    assert kept.count() == 1 and dropped.count() == 1
    rules = sorted((r["rule"], r["id"]) for r in validate.check_integrity(nodes.select("graph_ord", "id"), resolved).collect())
    assert rules == [("duplicate_edge_id", "e"), ("unknown_object", "e")]


def test_blocked_join_equals_brute_force(spark):
    words = ["a b c", "b c d", "x y", "", None, "c"]
    df = spark.createDataFrame(list(enumerate(words)), "id int, v string")
    pairs = matching.token_join(df, df, "id", "id", T.plain_tokens(F.col("v")), T.plain_tokens(F.col("v"))).withColumn("s", matching.overlap())
    found = {(r["left_id"], r["right_id"]): r["s"] for r in pairs.collect()}
    sets = [set((w or "").split()) for w in words]
    assert found == pytest.approx({(i, j): len(a & b) / len(a | b) for i, a in enumerate(sets) for j, b in enumerate(sets) if a & b})


def test_one_to_one_is_greedy_in_order(spark):
    df = spark.createDataFrame([(1, "p", 0.9), (2, "p", 1.0), (2, "q", 0.5), (3, "q", 0.8)], "left_ord int, right_id string, score double")
    assert {(r["left_ord"], r["right_id"]) for r in matching.one_to_one(df).collect()} == {(1, "p"), (2, "q")}


def test_one_to_one_computes_its_candidates_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kinds = "left_ord int, right_id string, score double"
    df = spark.createDataFrame([(1, "p", 0.9), (2, "p", 1.0), (2, "q", 0.5), (3, "q", 0.8), (3, "r", 0.1)], kinds).mapInArrow(counted, kinds)
    assert {(r["left_ord"], r["right_id"]) for r in matching.one_to_one(df).collect()} == {(1, "p"), (2, "q"), (3, "r")}
    assert seen.value == 5


def test_sizes_leave_out_only_pairs_below_the_overlap(spark):
    df = spark.createDataFrame([(0, "a b c d"), (1, "a"), (2, "a b"), (3, "a x y z"), (4, "")], "id int, text string")
    words = T.plain_tokens(F.col("text"))
    every = matching.token_join(df, df, "id", "id", words, words)
    fewer = matching.token_join(df, df, "id", "id", words, words, least_overlap=0.5)
    assert fewer.count() < every.count()
    kept, kept_of_all = (sorted(map(tuple, matching.similar_pairs(x, matching.overlap(), 0.5).collect())) for x in (fewer, every))
    assert kept == kept_of_all and len(kept) == 8


def test_nodes_meet_without_a_row_for_each_token(spark, capsys):
    kinds = "doc int, ord int, id string, entity_term string, measured_attribute string, entity_type string"
    primary = spark.createDataFrame([(0, 1, "a", "Culex pipiens", "larval abundance", "taxon"), (0, 2, "b", "culex pipiens", "abundance", "other"), (0, 3, "c", "", "", "taxon"), (1, 1, "d", "Culex", "abundance", "taxon")], kinds)
    witness = spark.createDataFrame([(0, 1, "x", "Culex  pipiens", "abundance", "taxon"), (0, 2, "y", "salinity", "", "taxon"), (0, 3, "z", "pipiens culex", "", "taxon"), (2, 1, "v", "Culex", "abundance", "taxon"), (None, 1, "u", "Culex", "", "taxon")], kinds)
    found = agreement.map_nodes(primary, witness, ["doc"], ["entity_type"])
    assert {(r["witness_id"], r["primary_id"], round(r["score"], 4), r["conflicts"]) for r in found.collect()} == {("x", "b", 1.0, 1), ("z", "a", 0.81, 0)}
    found.explain()
    assert "Generate" not in capsys.readouterr().out


def test_resolved_endpoints_of_large_tables(spark, capsys):
    nodes = spark.createDataFrame([(0, 1, "r", "i1", "N"), (0, 2, "r", "i2", "N"), (0, 3, None, "i3", "r"), (0, 4, "i3", "i4", None), (1, 1, "r", "k", "N")], "graph_ord int, item_ord int, raw_id string, id string, name string")
    edges = spark.createDataFrame([(0, "r", "N"), (0, "i3", "i1"), (0, None, "zz"), (1, "N", "i1")], "graph_ord int, subject string, object string")
    found = normalize.resolve_endpoints(edges, nodes, ["subject", "object"], slices=7)
    assert {(r["graph_ord"], r["subject"], r["object"]) for r in found.collect()} == {(0, "i2", "i1"), (0, "i4", "i1"), (0, None, "zz"), (1, "k", "i1")}
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == plan.count(", 7), REPARTITION_BY_NUM") > 0


def test_statuses_from_one_join(spark):
    primary = spark.createDataFrame([(0, "e1", "a", "b", "causes"), (0, "e2", "b", "a", "causes"), (0, "e3", "c", "d", "causes"), (0, "e4", "c", "d", "prevents"), (0, "e5", "x", "x", "causes"), (0, "e6", None, "x", "causes"), (1, "e7", "a", "b", "causes")], "doc int, id string, subject string, object string, predicate string")
    witness = spark.createDataFrame([(0, "w1", "1", "b", "a", "causes"), (0, "w1", "2", "d", "c", "causes"), (0, "w2", "1", "c", "d", "causes"), (0, "w2", "2", "x", "x", "causes"), (0, "w2", "3", None, "x", "causes"), (1, "w2", "1", "a", "b", "causes"), (1, "w1", "1", "a", "b", None)], "doc int, witness string, id string, subject string, object string, predicate string")
    answered = primary.select("doc").distinct().crossJoin(witness.select("witness").distinct())
    for slices in (None, 5):
        verdicts, omitted = agreement.edge_verdicts(primary, witness, ["doc"], ["predicate"], slices)
        best = agreement.reduced(verdicts, ["doc"], slices)
        assert {(r["id"], r["witness"], r["verdict"]) for r in best.collect()} == {("e2", "w1", "agrees"), ("e3", "w1", "conflict"), ("e4", "w1", "conflict"), ("e3", "w2", "agrees"), ("e4", "w2", "conflict"), ("e5", "w2", "agrees"), ("e7", "w2", "agrees"), ("e7", "w1", "agrees")}
        assert [(r["doc"], r["w_id"], r["subject"]) for r in omitted.collect()] == [(0, "3", None)]
        one = agreement.edge_statuses(primary, witness, ["doc"], ["predicate"], ["w1", "w2"], slices)
        assert sorted(map(str, one.collect())) == sorted(map(str, agreement.item_statuses(primary.select("doc", "id"), best, answered, ["doc"]).collect()))


def test_agreement(spark):
    primary = spark.createDataFrame([(0, "e1", "a", "b", "causes", None), (0, "e2", "b", "c", "causes", True), (0, "e3", "c", "d", "causes", False)], "doc int, id string, subject string, object string, predicate string, negated boolean")
    witness = spark.createDataFrame([(0, "w1", "x1", "a", "b", "causes", False), (0, "w1", "x2", "c", "b", "causes", True), (0, "w1", "x3", "a", "d", "causes", False)], "doc int, witness string, id string, subject string, object string, predicate string, negated boolean")
    verdicts, omitted = agreement.edge_verdicts(primary, witness, ["doc"], ["predicate", "negated"])
    assert {(r["id"], r["verdict"], tuple(r["conflicts"])) for r in verdicts.collect()} == {("e1", "agrees", ()), ("e2", "conflict", ("direction",))}
    assert [r["w_id"] for r in omitted.collect()] == ["x3"]
    answered = spark.createDataFrame([(0, "w1")], "doc int, witness string")
    found = {r["id"]: r["status"] for r in agreement.item_statuses(primary.select("doc", "id"), agreement.reduced(verdicts, ["doc"]), answered, ["doc"]).collect()}
    assert found == {"e1": "agreed", "e2": "conflict", "e3": "unsupported"}
    none = {r["status"] for r in agreement.item_statuses(primary.select("doc", "id"), agreement.reduced(verdicts, ["doc"]), answered.limit(0), ["doc"]).collect()}
    assert none == {"unchecked"}


def test_confidence(spark):
    import math

    tokens = spark.createDataFrame([("i", "predicate", "decision", "dir", math.log(0.5), 1), ("i", "predicate", "decision", "ect", math.log(0.9), 2), ("i", "name", "content", "x", float("-inf"), 3)], "item string, field string, kind string, token string, logprob double, ord int")
    fields = {r["field"]: r for r in confidence.score_fields(tokens, ["item", "field"], ["ord"]).collect()}
    assert fields["predicate"]["p"] == 0.45 and fields["predicate"]["pivot"] == "dir" and fields["name"]["min_logprob"] == -100
    scored = confidence.score_fields(tokens, ["item", "field"], ["ord"]).withColumn("field_ord", F.col("field"))
    assert confidence.score_items(scored, ["item"], ["predicate"]).head()["weakest_field"] == "predicate"
    edges = spark.createDataFrame([("e", "a", "b", 0.8), ("e", "a", "b", 0.95)], "id string, subject string, object string, score double")
    nodes = spark.createDataFrame([("a", 0.7), ("b", None)], "id string, score double")
    row = confidence.claim_scores(edges, nodes, []).head()
    assert (row["score"], row["edge_score"], row["bucket"], row["limited_by"]) == (0.7, 0.95, "medium", "subject")


def test_windows_and_passages(spark):
    rows = [("d", i, -4.0 if 30 <= i < 40 else -0.125) for i in range(100)]
    windows = confidence.surprise_windows(spark.createDataFrame(rows, "d string, i0 int, logprob double"), ["d"], ["i0"])
    assert [r["start"] for r in windows.orderBy("start").collect()] == [0, 24, 48]
    top = confidence.top_passages(windows, ["d"]).orderBy("rank").collect()
    assert [r["start"] for r in top] == [0, 48]


def test_chunks_have_exact_offsets(spark):
    text = "Intro here.\n\n## Methods\n  We did it. Then more! And more?\n# Page 3\nLast one."
    docs = spark.createDataFrame([(1, text), (2, "  \n"), (3, None), (4, "One. Two.")], "doc_id int, text string")
    found = chunking.chunks(docs, most_characters=25, overlap=4).orderBy("doc_id", "chunk_no").collect()
    texts = {1: text, 4: "One. Two."}
    assert {r["doc_id"] for r in found} == {1, 4}
    for r in found:
        assert texts[r["doc_id"]][r["start_char"] : r["end_char"]] == r["text"]
    assert {r["section"] for r in found} == {"document", "methods", "page 3"} and max(r["page"] or 0 for r in found) == 3
    whole = chunking.chunks(docs, most_characters=None).collect()
    assert {(r["doc_id"], r["text"]) for r in whole} == set(texts.items())


def test_ris_records_and_manifest(spark):
    text = "TY  - JOUR\nTI  - <span>First</span> title\nAU  - Smith, J\nAU  - Roe, R\nPY  - 1995\nAB  - one\n  two\nL1  - files/a.pdf\nER  - \n\nTY  - JOUR\nT1  - Second\nDA  - 2008///\nDO  - 10.1000/X.1.\n"
    docs = ris.records(spark.createDataFrame([("f", text)], "file string, text string"))
    rows = ris.manifest(docs, ["record_no"]).orderBy("record_no").collect()
    assert [r["title"] for r in rows] == ["First title", "Second"] and rows[0]["abstract"] == "one two" and rows[0]["authors"] == ["Smith, J", "Roe, R"]
    assert [r["year"] for r in rows] == [1995, 2008] and rows[1]["document_id"] == "10.1000/x.1" and rows[0]["slug"] == "smith_1995_first_title" and rows[0]["links"] == ["files/a.pdf"]


def test_graph_files(spark, tmp_path):
    graph = {"graph_id": "g", "nodes": [{"id": "n1", "name": "A", "unknown": 1}], "edges": [{"id": "e", "subject": "n1", "object": "n1", "predicate": "causes"}]}
    (tmp_path / "a.json").write_text(json.dumps(graph))
    (tmp_path / "a.confidence.json").write_text("{}")
    (tmp_path / "broken.json").write_text("{")
    listed = graphs.list_graphs(spark, str(tmp_path))
    assert sorted((r["graph_ord"], r["path"].rpartition("/")[2], r["content"]) for r in listed.collect()) == [(1, "a.json", json.dumps(graph)), (2, "broken.json", "{")]
    read = graphs.read_graphs(listed)
    assert graphs.child(read, "nodes").select("id", "name").collect() == [Row(id="n1", name="A")] and graphs.child(read, "edges").count() == 1
    nested = graphs.nest(graphs.child(read, "nodes"), graphs.child(read, "edges"), ["graph_ord"]).head()["graph"]
    assert json.loads(nested)["nodes"][0]["id"] == "n1"


def test_ontology(spark, tmp_path):
    xml = """<rdf:RDF xmlns:rdf="http://r#" xmlns:owl="http://o#" xmlns:rdfs="http://s#" xmlns:skos="http://k#"><owl:Class rdf:about="http://x/ENVO_1"><rdfs:label>salt marsh</rdfs:label><skos:altLabel>saltmarsh</skos:altLabel></owl:Class><owl:Class rdf:about="http://orcid.org/1"><rdfs:label>person</rdfs:label></owl:Class></rdf:RDF>"""
    (tmp_path / "o.owl").write_text(xml)
    prefixes = spark.createDataFrame([("ENVO", "http://x/ENVO_"), ("orcid", "http://orcid.org/")], "prefix string, base string")
    rows = ontology.terms(ontology.read_classes(spark, str(tmp_path / "o.owl")), prefixes).collect()
    assert [(r["curie"], r["label"], r["synonyms"]) for r in rows] == [("ENVO:1", "salt marsh", ["saltmarsh"])]


def test_sqlite_manifest(spark, tmp_path):
    with sqlite3.connect(tmp_path / "m.db") as db:
        db.execute("create table documents (id text, md_path text, title text)")
        db.executemany("insert into documents values (?, ?, ?)", [("1", "a.md", "T"), ("2", "b.txt", "U")])
    sqlite_manifest.register(spark)
    rows = spark.read.format("sqlite_manifest").load(str(tmp_path / "m.db")).collect()
    assert [(r["ord"], r["document_id"], r["title"], r["path"]) for r in rows] == [(1, "1", "T", str(tmp_path / "a.md"))]


def test_incremental(spark, tmp_path):
    rows = spark.createDataFrame([("a", ""), ("b", "x")], "k string, v string")
    old = spark.createDataFrame([("a", "old"), ("c", "c")], "k string, v string")
    assert {(r["k"], r["v"]) for r in incremental.carry_forward(rows, old, "k", ["v"]).collect()} == {("a", "old"), ("b", "x")}
    assert [r["k"] for r in incremental.not_done(rows, old, "k").collect()] == ["b"]
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in (rows, rows.unionByName(old)):
        batch.write.mode("append").parquet(source)
        incremental.merge_new_files(spark, source, "k string, v string", target, str(tmp_path / "cp"), ["k"]).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_grounding(spark):
    from claimloom.operators import grounding

    terms = spark.createDataFrame([("soil salinity",), ("grubbing",), ("very old soil salinity",), ("Mosquito",), ("ENVO:9",), ("nothing here",)], "term string")
    local = spark.createDataFrame([("L:1", "salinity of soil", []), ("L:2", "grubbing process", ["clearing"])], "curie string, label string, synonyms array<string>")
    other = spark.createDataFrame([("O:1", "soil salinity", [])], "curie string, label string, synonyms array<string>")
    overrides = spark.createDataFrame([(" MOSQUITO", "T:1", "Culicidae")], "term string, curie string, label string")
    rows = grounding.ground_terms(terms, [(0, local), (1, other)], overrides)
    found = {r["term"]: (r["curie"], r["via"]) for r in rows.collect()}
    assert found == {"soil salinity": ("L:1", "phrase"), "grubbing": ("L:2", "phrase"), "very old soil salinity": ("L:1", "tail"), "Mosquito": ("T:1", "override")}
    counts = grounding.grounding_counts(terms, rows).head()
    assert (counts["terms"], counts["identifiers"], counts["matched"], counts["missed"], counts["tail"]) == (6, 1, 4, 1, 1)
    assert {r["term"] for r in grounding.ground_column(terms, rows, "term").collect()} >= {"L:1", "T:1", "ENVO:9"}


def test_schema_compiler(spark):
    from claimloom.sources.schema import compile_schema, interpolate

    profile = compile_schema({
        "enums": {"Kind": {"permissible_values": {"taxon": {}, "process": {}}}},
        "slots": {"id": {"identifier": True, "required": True}, "weight": {"range": "float", "minimum_value": -1, "maximum_value": 1}},
        "classes": {"Base": {"slots": ["id"]}, "Node": {"is_a": "Base", "attributes": {"kind": {"range": "Kind", "ifabsent": "string(taxon)"}, "part_of": {"range": "Node", "multivalued": True}}}, "Edge": {"slots": ["id", "weight"], "attributes": {"to": {"range": "Node"}}}},
    })
    assert profile.struct("Node").simpleString() == "struct<id:string,kind:string,part_of:array<string>>" and profile.reachable("Edge") == ["Edge", "Node"]
    edges = spark.createDataFrame([(0, "a", 0.5), (0, None, 2.0)], "graph_ord int, id string, weight double")
    assert sorted(r["rule"] for r in validate.check_rules(edges, profile.checks("Edge")).collect()) == ["id: required", "weight: maximum"]
    assert interpolate({"a": ["${X:-d}", "${Y}z"]}, {"Y": "1"}) == {"a": ["d", "1z"]}


def test_json_positions_and_alignment(spark):
    from claimloom.functions.positions import align_tokens, json_spans, reply_values

    text = '<think>{"no"</think> so { {"a": [1, {"b": "x\\"y"}], "c": null}'
    spans = {p: text[s:e] for p, s, e in json_spans(text)}
    assert spans["a[1].b"] == '"x\\"y"' and spans["c"] == "null" and spans["a[0]"] == "1"
    assert json_spans('{"a": 1,}') == [] and json_spans(None) == []
    assert align_tokens(["x", "He", "llo", "!"], "Hello") == [None, (0, 2), (2, 5), None]
    assert align_tokens(["He", "##", "lo"], "Hello") == [(0, 2), None, (3, 5)]
    rows = reply_values(spark.createDataFrame([(1, text), (2, None)], "reply int, text string"), "reply").collect()
    assert len(rows) == 6 and {r["reply"] for r in rows} == {1}


def test_replies_become_graphs(spark):
    from claimloom.operators import extract

    reply = {"nodes": [{"id": "n1", "name": "Rain", "entity_term": "rain", "junk": 1}, {"name": "Flood", "entity_term": "flood"}], "edges": [{"subject": "n1", "object": "Flood", "predicate": "causes"}, {"subject": "n1", "object": "gone", "predicate": "causes"}]}
    parsed = extract.parsed_replies(spark.createDataFrame([(7, "```json\n" + json.dumps(reply) + "\n```"), (8, "no")], "chunk int, text string"), "chunk")
    found = extract.normalized_graph(parsed, "chunk")
    ids = {r["name"]: r["id"] for r in found["nodes"].collect()}
    assert ids["Rain"] == "n1" and ids["Flood"].startswith("camo:node_")
    assert [(r["subject"], r["object"]) for r in found["edges"].collect()] == [("n1", ids["Flood"])] and found["dropped"].count() == 1


def test_corpus_run_is_incremental_and_gated(spark, tmp_path):
    from claimloom.plans import stages

    graph = lambda a, b: json.dumps({"nodes": [{"id": "n1", "name": a, "entity_term": a}, {"id": "n2", "name": b, "entity_term": b}], "edges": [{"subject": "n1", "object": "n2", "predicate": "causes"}]})
    docs = spark.createDataFrame([(1, "One. Two."), (2, "Three.")], "doc_id int, text string")
    replies = spark.createDataFrame([(1, graph("Rain", "Flood")), (2, graph("rain ", "Loss | x"))], "doc_id int, text string")
    folder = str(tmp_path / "run")
    first = stages.run_corpus(spark, folder, docs.limit(1), replies.where("doc_id = 1"))
    assert first["nodes"].count() == 2
    both = stages.run_corpus(spark, folder, docs, replies)
    assert both["nodes"].count() == 3 and both["edges"].count() == 2 and both["chunks"].count() == 2
    version = stages.write_back(spark, str(tmp_path / "merged"), both["nodes"], both["edges"])
    nodes, edges = stages.current(spark, str(tmp_path / "merged"))
    assert version and nodes.count() == 3 and edges.count() == 2
    with pytest.raises(ValueError):
        stages.write_back(spark, str(tmp_path / "merged"), both["nodes"].limit(1), both["edges"])
    assert stages.current(spark, str(tmp_path / "merged"))[0].count() == 3
    later = stages.write_back(spark, str(tmp_path / "merged"), both["nodes"], both["edges"].limit(1))
    assert later != version and stages.current(spark, str(tmp_path / "merged"))[1].count() == 1
    assert "Loss \\| x" in stages.markdown_table(nodes, ["entity_term"], ["entity_term"])


def test_tokens_align_by_bytes_and_anchors():
    from claimloom.functions.positions import align_tokens

    raw = [b"x", "é".encode()[:1], "é".encode()[1:] + b"t", "é".encode()]
    assert align_tokens(["x", "\ufffd", "\ufffdt", "é"], "été", raw=raw) == [None, (0, 1), (0, 2), (2, 3)]
    answer = '{"claim": "the caf\u00e9 opened early"}'
    thought = ["{", '"', "the "] + [f"thought{i} " for i in range(60)]
    said = ['{"claim": ', '"the caf', "\ufffd", "\ufffd", " opened", ' early"}']
    spans = align_tokens(thought + said, answer, from_end=True)
    assert spans[: len(thought)] == [None] * len(thought)
    assert [x and answer[slice(*x)] for x in spans[len(thought) :]] == ['{"claim": ', '"the caf', "é", "é", " opened", ' early"}']


def test_manifest_texts(spark):
    assert one(spark, T.manifest_year(F.col("v")), v="c. 2021; 1999") == 2021
    assert one(spark, T.manifest_year(F.col("v")), v="x2021 31999") is None
    assert one(spark, T.author_list(F.col("v")), v="A, B ; C and  D;") == ["A, B", "C", "D"]
    assert one(spark, T.author_list(F.lit(None).cast("string")), v=1) == []
    assert one(spark, T.safe_name(F.col("v")), v="__a b/c__") == "a_b_c"
    assert one(spark, T.safe_name(F.col("v")), v="//") == "witness"
    assert one(spark, T.shortened(F.col("v"), 6), v=" ab  cd ef ") == "ab cd…"
    assert one(spark, T.shortened(F.col("v"), 8), v=" ab  cd ef ") == "ab cd ef"
    assert one(spark, T.comparable_list(F.col("v")), v=["b ", "A  x"]) == ["a x", "b"]


def test_relative_paths(spark):
    for path, found in (("/a/b/c.pdf", "b/c.pdf"), ("/a", "."), ("/ab/c", None), (None, None)):
        assert one(spark, T.relative_path(F.lit(path).cast("string"), "/a/"), v=1) == found
    ref = lambda i, d: F.struct(F.lit(i).cast("string").alias("document_id"), F.lit(d).cast("string").alias("doi"))
    assert [one(spark, T.document_ref(ref(*x)), v=1) for x in (("i", "d"), ("", "d"), (None, None))] == ["i", "d", None]
    wants = lambda d, x: one(spark, T.wants_identifier(F.lit(d).cast("string"), F.lit(x)), v=1)
    assert [wants("A CURIE of it", False), wants("A CURIE of it", True), wants("plain", False), wants(None, False)] == [True, False, False, False]


def test_quote_found(spark):
    found = lambda e: one(spark, reports.quote_found(F.expr(e)), v=1)
    assert found("array(named_struct('start_char', 1))")
    assert not found("array(named_struct('start_char', 1), named_struct('start_char', cast(null as int)))")
    assert not found("cast(array() as array<struct<start_char:int>>)")
    assert not found("cast(null as array<struct<start_char:int>>)")


def test_reports(spark):
    edges = spark.createDataFrame([(1, "a", "b", "causes", True), (1, "a", "z", "causes", None)], "g int, subject string, object string, predicate string, negated boolean")
    names = spark.createDataFrame([(1, "a", "Soil"), (1, "b", ""), (2, "z", "other")], "g int, id string, name string")
    assert {r["label"] for r in reports.edge_labels(edges, names, ["g"]).collect()} == {"Soil --NOT causes--> b", "Soil --causes--> z"}
    rows = spark.createDataFrame([(1, ["x"], True, "b"), (1, ["x", "y"], False, "c"), (1, ["x"], True, "a"), (1, ["x"], False, "0")], "g int, witnesses array<string>, endpoints_in_primary boolean, label string")
    assert [r["label"] for r in reports.ranked_omissions(rows, ["g"]).orderBy("rank").collect()] == ["c", "a", "b", "0"]
    items = spark.createDataFrame([("partial", "low"), ("conflict", None), ("conflict", "high"), ("agreed", "low"), ("unchecked", "low"), ("odd", "low")], "status string, confidence string")
    assert [tuple(r)[:2] for r in reports.ranked_disputes(items).collect()] == [("conflict", "high"), ("conflict", None), ("partial", "low"), ("odd", "low")]
    entries = spark.createDataFrame([(1, "a", 0.5, False), (2, "a", None, None), (2, "q", None, None)], "graph_ord int, old_id string, score double, flagged boolean")
    ids = spark.createDataFrame([(1, "a", "m"), (2, "a", "m")], "graph_ord int, old_id string, new_id string")
    assert {tuple(r) for r in reports.merged_index(reports.merged_sources(entries, ids)).collect()} == {("m", 2, 0.5, False), ("q", 1, None, False)}
    names = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, ""), (2, None)], "g int, s string")
    assert {tuple(r) for r in names.groupBy("g").agg(reports.snapshot_union("s")).collect()} == {(1, "a; b"), (2, None)}
    assert [tuple(r) for r in reports.tally(names, "s").orderBy("place").collect()][0] == ("b", 2, 1)
    usage = spark.createDataFrame([(1, 0.0, 2.0, None), (1, 3.0, 9.0, 5), (2, None, None, None)], "d int, answer_perplexity double, perplexity double, reasoning_tokens long")
    assert {tuple(r) for r in reports.usage_totals(usage, ["d"]).collect()} == {(1, 2.5, 5), (2, None, 0)}
    assert tuple(reports.manifest_counts(spark.createDataFrame([("p", "link"), ("", "no_pdf"), (None, "unmatched_pdf")], "pdf_path string, match string")).head()) == (3, 1, 1, 1)
