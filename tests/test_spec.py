import copy

import pytest

from stratum.spec import PipelineSpec, flag, load_spec

TEXT = """
pipeline_metadata: {name: mails, layer: silver, environment: dev, run_mode: execute}
source:
  type: delta_table
  properties: {table: lake.raw.mails, format: delta}
transform:
  standardize: {trim_strings: true}
data_quality:
  - check:
      function: sql_expression
      arguments: {expression: "mail like '%@%'", msg: no mail address, name: mail_form}
      criticality: warn
destination: {mode: overwrite, table: lake.refined.mails}
security:
  masking: [{column: mail, policy: mask_text}]
"""


def base():
    return {"pipeline_metadata": {"name": "n", "layer": "bronze"},
            "source": {"type": "file", "properties": {"source_path": "/x", "format": "csv"}},
            "destination": {"table": "t"}}


def changed(path, value):
    config = copy.deepcopy(base())
    node = config
    for key in path[:-1]:
        node = node.setdefault(key, {})
    node[path[-1]] = value
    return config


def test_yaml(tmp_path):
    path = tmp_path / "s.yml"
    path.write_text(TEXT)
    spec = load_spec(str(path))
    assert (spec.layer, spec.source.kind, spec.source.table) == ("silver", "table", "lake.raw.mails")
    assert spec.rules[0].criticality == "warn" and spec.transform.standardize["trim_all"]
    assert spec.target.mode == "overwrite" and spec.masks[0]["column"] == "mail"


def test_defaults():
    spec = PipelineSpec.of(base())
    assert spec.target.mode == "append" and spec.on_fail == "record"
    assert spec.source.split_enabled and spec.source.header_mode == "auto" and spec.source.last_n_days is None


@pytest.mark.parametrize("path,value", [
    (("source", "type"), "rest"),
    (("source", "type"), None),
    (("source", "properties"), {"format": "csv"}),
    (("source", "properties"), {"source_path": "/x"}),
    (("source",), {"type": "table", "properties": {}}),
    (("source",), {"type": "jdbc", "properties": {"table": "t"}}),
    (("source",), None),
    (("pipeline_metadata",), None),
    (("pipeline_metadata", "layer"), "iron"),
    (("destination", "mode"), "upsert"),
    (("destination", "mode"), "merge"),
    (("destination",), {}),
    (("destination",), {"table": "t", "enable_soft_deletes": True}),
    (("destination",), [{"table": "a"}, {"table": "b"}]),
    (("destination", "materialization"), "cube"),
    (("destination", "corrupt_record"), "bad"),
    (("security",), {"masking": [{"column": "a", "policy": "nope"}]}),
    (("security",), {"masking": [{"policy": "mask_text"}]}),
    (("on_fail",), "ignore"),
    (("data_quality",), [{"check": {"function": "other"}}]),
])
def test_bad_specs_are_refused(path, value):
    with pytest.raises(ValueError):
        PipelineSpec.of(changed(path, value))
    with pytest.raises(ValueError):
        PipelineSpec.of([])


def test_date_folders_and_split_settings():
    props = {"source_path": "/x", "format": "csv",
             "discover": {"type": "date_hierarchy", "multi_split": {"enabled": "no", "header": "One_Header"}}}
    source = PipelineSpec.of(changed(("source", "properties"), props)).source
    assert (source.last_n_days, source.split_enabled, source.header_mode) == (1, False, "one_header")


def test_own_policies():
    spec = PipelineSpec.of(changed(("security",), {
        "masking": [{"column": "a", "policy": "first"}], "policies": {"first": "left({col}, 1)"}}))
    assert spec.policies["first"] == "left({col}, 1)" and "mask_text" in spec.policies


def test_flags():
    assert [flag(v) for v in (True, "Yes", "1", 1, "on")] == [True] * 5
    assert [flag(v) for v in (False, "no", "0", 0, "", None)] == [False] * 6 and flag(None, True)


@pytest.mark.parametrize("part, setting", [
    ("source", {"typo": 1}), ("transform", {"filter": ["x"]}), ("transform", {"standardize": {"trim": True}}),
    ("transform", {"on_column_error": "ignore"}), ("transform", {"hash_mode": "fast"}), ("destination", {"keys": ["k"]}),
])
def test_settings_without_effect_are_refused(part, setting):
    config = {"pipeline_metadata": {"layer": "silver"}, "source": {"type": "table", "table": "t"},
              "transform": {}, "destination": {"table": "u"}}
    PipelineSpec.of(config)
    with pytest.raises(ValueError):
        PipelineSpec.of({**config, part: {**config[part], **setting}})
