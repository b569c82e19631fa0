"""Names shared by the tests of the optional subpackage."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
