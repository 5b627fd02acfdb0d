"""Output names and tokens that must equal the reference's,
so that keys hash identically and check results carry the same columns."""

# Surrogate-key NULL token and field separator.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"

# Default source-name column of the superset union.
UNION_SOURCE_COLUMN = "_dbt_source_relation"

# Constant join-key columns of the two row-count checks.
EQUAL_ROWCOUNT_ID = "id_dbtutils_test_equal_rowcount"
FEWER_ROWS_THAN_ID = "id_dbtutils_test_fewer_rows_than"

# Output columns of the checks, and the values of the difference column.
FILLER = "filler_column"
NUM_ROWS = "num_rows"
COUNT_A = "count_a"
COUNT_B = "count_b"
DIFF_COUNT = "diff_count"
COUNT_OURS = "count_our_model"
COUNT_COMPARED = "count_comparison_model"
ROW_COUNT_DELTA = "row_count_delta"
WHICH_DIFF = "which_diff"
A_MINUS_B = "a_minus_b"
B_MINUS_A = "b_minus_a"
MOST_RECENT = "most_recent"
THRESHOLD = "threshold"
VALUE_FIELD = "value_field"
RIGHT_ID = "right_id"
FROM_FIELD = "from_field"

# Words in the output columns of the range check.
EQUAL_TO = "equal_to"
LESS_OR_EQUAL = "less_than_or_equal_to"
LESS = "less_than"
