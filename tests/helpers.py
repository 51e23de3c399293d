"""Small hand-made stores and releases for unit tests."""

from __future__ import annotations

import json
import os

from conceptnorm.plans.vocabulary import Vocabulary


def store_from_rows(spark, types=(), identifiers=(), cliques=(), descriptions=(),
                    identifiers_descriptions=(), identifiers_cliques=(), identifiers_taxa=(),
                    conflation_clusters=(), conflation_members=()) -> Vocabulary:
    schemas = {
        "types": "id bigint, curie string",
        "identifiers": "id bigint, curie string, label string",
        "cliques": "id bigint, primary_identifier_id bigint, ic double, type_id bigint, "
                   "preferred_name string",
        "descriptions": "id bigint, desc string",
        "identifiers_descriptions": "description_id bigint, identifier_id bigint",
        "identifiers_cliques": "identifier_id bigint, clique_id bigint",
        "identifiers_taxa": "identifier_id bigint, taxa_identifier_id bigint",
        "conflation_clusters": "id bigint, type int",
        "conflation_members": "cluster_id bigint, identifier_id bigint, is_canonical int",
    }
    rows = dict(types=types, identifiers=identifiers, cliques=cliques, descriptions=descriptions,
                identifiers_descriptions=identifiers_descriptions,
                identifiers_cliques=identifiers_cliques, identifiers_taxa=identifiers_taxa,
                conflation_clusters=conflation_clusters, conflation_members=conflation_members)
    tables = {k: spark.createDataFrame(list(rows[k]), schemas[k]) for k in schemas}
    return Vocabulary.from_tables(tables)


def write_lines(folder: str, name: str, lines: list[str]) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def record(type_, members, ic=None, name="x", taxa=()):
    return json.dumps({"type": type_, "ic": ic, "identifiers": members,
                       "preferred_name": name, "taxa": list(taxa)})


# A small release with every edge case of the format: descriptions on the
# first record only, undefined taxa, unlabelled secondary members, a member
# seen first without a label, one non-null ic, keys in varying order.
SAMPLE_COMPENDIA = {
    "OrganismTaxon.txt": [
        record("biolink:OrganismTaxon", [{"i": "TX:1", "l": "Taxon one", "d": [], "t": []}],
               name="Taxon one"),
    ],
    "Gene.txt": [
        record("biolink:Gene", [{"i": "G:1", "l": "gene one", "d": ["first desc", "second desc"],
                                 "t": ["TX:1"]},
                                {"i": "E:1", "d": [], "t": []}], name="gene one", taxa=["TX:1"]),
        "",
        record("biolink:Gene", [{"i": "G:2", "l": "gene two", "d": [], "t": ["TX:9"]}],
               ic=83.4, name="gene two", taxa=["TX:9"]),
        json.dumps({"identifiers": [{"i": "G:3", "l": "gene three", "t": ["TX:8"]}],
                    "taxa": ["TX:8"], "preferred_name": "gene three", "ic": None,
                    "type": "biolink:Gene"}),
        record("biolink:Gene", [{"i": "G:4", "l": "gene four", "d": [], "t": []},
                                {"i": "P:1", "d": [], "t": []}], name="gene four"),
    ],
    "Protein.txt": [
        record("biolink:Protein", [{"i": "P:1", "l": "protein one", "d": [], "t": []},
                                   {"i": "G:4", "l": "ignored later label", "d": [], "t": []}],
               name="protein one"),
    ],
}
SAMPLE_CONFLATION = {
    "GeneProtein.txt": ['["P:1", "G:4"]', "['G:1', 'E:1']", ""],
}
SAMPLE_TYPES = ["biolink:Gene", "biolink:OrganismTaxon", "biolink:Protein"]


def write_sample_release(root: str) -> str:
    for name, lines in SAMPLE_COMPENDIA.items():
        write_lines(os.path.join(root, "compendia"), name, lines)
    for name, lines in SAMPLE_CONFLATION.items():
        write_lines(os.path.join(root, "conflation"), name, lines)
    return root
