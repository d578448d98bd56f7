"""What the tests of this folder share besides fixtures."""

SMALL = "/root/testdata/sf0.001"


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
