"""The text queries see what stands far behind the start of a text."""

import pytest

from vestigo.plans import queries as plans

FAR = "palavra, " * 5000


@pytest.fixture
def far(spark, tmp_path):
    def write(*tails):
        rows = [(i, FAR + t) for i, t in enumerate(tails)]
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write


def test_cleaned_whole(spark, far):
    got = plans.QUERIES["clean_signer"](spark, far("ANA \n SILVA .;-")).first().nome
    assert got == FAR + "ANA SILVA"


def test_names_of_a_whole_certificate(spark, far):
    names = [f"NOME {c * 3} SILVA" for c in "ABCDEF"]
    got = plans.QUERIES["certificate_names"](spark, far("1".join([*names[:2], *names]))).first().nomes
    assert got == names[:5]


def test_stamps_and_labels_behind_any_text(spark, far):
    """doc_id % 4 decides what is put behind the text; nothing of the text gives way to it."""
    path = far(*["\nassinado por: ANA\n"] * 4, *["\nRecebi o documento"] * 4)
    signers = {r.doc_id: (r.signatario, r.n_hits) for r in plans.QUERIES["signer_extract"](spark, path).collect()}
    assert [signers[i][0] for i in range(4)] == ["ANA"] * 4 and [signers[i][1] for i in range(8)] == [3, 1, 1, 1, 2, 1, 0, 0]
    cues = {r.doc_id: r.rotulo for r in plans.QUERIES["signature_label_cue"](spark, path).collect()}
    assert [cues[i] for i in range(8)] == [False, False, True, False, True, True, True, True]
