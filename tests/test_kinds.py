"""Queue files routed by name to a schema per kind; what doesn't fit goes to the dead letters."""

import json
import os

from recordsync.streaming import ingest as I
from recordsync.streaming.kinds import KindSink, dead_letters, read_files, typed

LEAD = {"Lead": {"Id": 1, "Company": "A", "Address": {"City": "C"}, "CustomFields": [{"id": "x", "value": "1"}], "Contact": [{"Id": 5}]}}
FILES = {
    "update_leads_in_erp_A_1.json": json.dumps(LEAD),
    "update_leads_in_erp_null.json": json.dumps({"Lead": {"Id": 2, "Company": None}}),
    "update_leads_in_erp_key.json": json.dumps({"Lead": LEAD["Lead"] | {"New": 1, "Address": {"Block": 2}}, "More": 3}),
    "update_leads_in_erp_type.json": json.dumps({"Lead": {"Id": "seven"}}),
    "update_leads_in_erp_list.json": "[1]", "update_leads_in_erp_empty.json": " \n",
    "converted_lead_B Ção.json": json.dumps(LEAD, indent=1),
    "lead_descartada_C.json": "whatever {", "inserted_timeline_1.json": '{"Id":3,"LeadId":1,"Text":"t"}',
    "inserted_timeline_cut.json": '{"Id":3,"LeadId":1,"Te', "contato_update_erp_1_5.json": '{"Id":5,"lead_cnpj":"0"}',
    "other.json": "{}", "update_leads_in_erp_not_json.txt": "{}"}
DEAD = [("inserted_timeline_cut.json", "timeline", "corrupt"), ("other.json", None, "unknown kind"),
        ("update_leads_in_erp_empty.json", "lead_update", "corrupt"),
        ("update_leads_in_erp_key.json", "lead_update", "unexpected: Lead.Address.Block,Lead.New,More"),
        ("update_leads_in_erp_list.json", "lead_update", "corrupt"), ("update_leads_in_erp_type.json", "lead_update", "corrupt")]


def land(folder, names):
    os.makedirs(folder, exist_ok=True)
    for name in names:
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(FILES[name])


def test_batch(spark, tmp_path):
    land(tmp_path / "q", FILES)
    docs = read_files(spark, str(tmp_path / "q"), stream=False)
    assert sorted(tuple(r)[:3] for r in dead_letters(docs).collect()) == DEAD
    assert {r.file: r.body for r in dead_letters(docs).collect()}["other.json"] == "{}"
    lead = {r.file: r.Lead for r in typed(docs, "lead_update").collect()}
    assert set(lead) == {"update_leads_in_erp_A_1.json", "update_leads_in_erp_null.json"}
    assert lead["update_leads_in_erp_A_1.json"].Contact[0].Id == 5 and lead["update_leads_in_erp_null.json"].Company is None
    assert [r.file for r in typed(docs, "lead_converted").collect()] == ["converted_lead_B Ção.json"]
    assert [(r.Id, r.Text) for r in typed(docs, "timeline").collect()] == [(3, "t")]


def test_stream_is_batch_and_replays_change_nothing(spark, tmp_path):
    queue, archive = tmp_path / "q", tmp_path / "archive"
    names = list(FILES)
    sink = KindSink(str(tmp_path / "tables"))
    for part in (names[:6], names[6:]):
        land(queue, part)
        stream = read_files(spark, str(queue), max_files=4, archive_dir=str(archive))
        I.start_sync(stream, str(tmp_path / "ckpt"), sink).awaitTermination()
    land(tmp_path / "all", FILES)
    docs = read_files(spark, str(tmp_path / "all"), stream=False)
    for kind in ("lead_update", "lead_converted", "contact_update", "timeline"):
        assert sorted(map(repr, sink.read(spark, kind).collect())) == sorted(map(repr, typed(docs, kind).collect()))
    assert sorted(tuple(r)[:3] for r in sink.read(spark, "dead_letters").collect()) == DEAD
    sink(docs, 0)  # a replayed epoch
    assert sink.read(spark, "dead_letters").count() == len(DEAD)
    assert list(archive.rglob("*.json"))  # consumed files are archived, discards with them
