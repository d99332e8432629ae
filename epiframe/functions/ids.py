"""Dataset identifiers and the signature that keys a snapshot."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: name shown for a dataset that was not given.
NO_DATASET = "<dataset>"


def dataset_id(path: Column, is_local: Column) -> Column:
    """``owner/name`` from the end of a local path; any other identifier as it is."""
    parts = F.split(F.regexp_replace(path, r"/+$", ""), "/")
    tail = F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), "/")).otherwise(parts[0])
    given = F.when(is_local, tail).otherwise(path)
    return F.when(F.coalesce(path, F.lit("")) == "", NO_DATASET).otherwise(given)


def recording_id(env: Column) -> Column:
    """Identifier of the dataset recorded from an environment."""
    return F.concat(F.lit("local/"), F.replace(F.lower(env), F.lit("-"), F.lit("_")), F.lit("_dr"))


def signature(repo_id: Column, root: Column, n_rows: Column, image_keys: Column, *more: Column) -> Column:
    """sha1 over the fields that decide what a snapshot contains."""
    keys = F.concat_ws(",", F.array_sort(image_keys))
    fields = [repo_id, F.coalesce(root, F.lit("")), n_rows.cast("string"), keys, *more]
    return F.sha1(F.concat_ws("|", *fields))
