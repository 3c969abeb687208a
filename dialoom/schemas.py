"""The domain's tables as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "turns": "audio_id string, start double, end double, speaker_label string",
    "labels": "audio_id string, content string, end double, file_path string, segment_id string, source_audio string, speaker_label string, start double",
    "dialogs": "dialog_id string, audio_id string, num_turns int, segment_ids array<string>, audio_clips array<string>, transcripts array<string>",
    "responses": (
        "manifest_line int, model string, input_mode string, line_error string, turns array<struct<turn_index:int,query:string,transcript_ref:string,audio:string,"
        "plain_text:string,semantic_content:string,acoustic_emotion:string,error:string,tts_audio:string,tts_error:string>>"
    ),
    "text_verdicts": "manifest_line int, raw_qc string, source_model string, passed boolean, summary string, issues array<string>, parse_error string",
    "audio_verdicts": (
        "manifest_line int, line_passed boolean, turns_qc array<struct<turn_index:int,is_pass:boolean,scores:struct<clarity:int,emotion:int,naturalness:int>,"
        "audio_issues:array<string>,review_summary:string,raw_qc:string,error:string,parse_error:string>>"
    ),
}


def schema(name: str) -> T.StructType:
    """The schema of a domain table by its name."""
    return T.StructType.fromDDL(_DDL[name])
