"""A registered query against its SQL on DuckDB, on sf0.01."""
import __spark_entry__ as entry
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


def same_as_oracle(spark, name):
    status, rows, _, _, message = compare(spark, duck(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert status == "OK" and rows, f"{status} {message}"
