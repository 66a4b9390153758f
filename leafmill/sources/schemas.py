"""Fixed schemas of the relations and of the exported record."""

from __future__ import annotations

from pyspark.sql.types import StructType

#: Table -> DDL. Times are UTC; ids are longs; metadata and log-probabilities are JSON text.
TABLES = {
    "volume": "barcode string, metadata string, pull_date timestamp",
    "pipeline_run": "id_pipeline_run bigint, items_total int, items_per_batch int, batches_total int, created_date timestamp",
    "pipeline_batch": "id_pipeline_batch bigint, id_pipeline_run bigint, node_name string, created_date timestamp, started_date timestamp, ended_date timestamp, has_crashed boolean",
    "pipeline_batch_item": "id_pipeline_batch_item bigint, id_pipeline_batch bigint, barcode string",
    "detection": "id_detection bigint, id_pipeline_batch_item bigint, scan_filename string, bbox_xyxy array<double>, bbox_xywh array<double>, bbox_conf double, orientation_correction_gen string, orientation_correction_confidence_gen double, orientation_correction_probs_gen string",
    "classification": "id_classification bigint, id_pipeline_batch_item bigint, id_detection bigint, pred_idx int, pred_class string, pred_conf double, probs array<double>, created timestamp",
    "image_embedding": "id_embedding bigint, id_pipeline_batch_item bigint, id_detection bigint, embedding array<float>, created timestamp",
    "image_hash": "id_imagehash bigint, id_pipeline_batch_item bigint, id_detection bigint, image_hash string, created timestamp",
    "caption": "id_caption bigint, id_pipeline_batch_item bigint, id_detection bigint, text string, lang string, logprobs string, lang_detected string, linear_prob double, thesaurus_matches string, created timestamp",
    "deduped_hash": "hash_id bigint, group_id bigint, id_pipeline_batch_item bigint, id_detection bigint, image_hash string, created timestamp",
    "deduped_embedding": "embedding_id bigint, group_id bigint, id_pipeline_batch_item bigint, id_detection bigint, created timestamp",
    "export_allow_list": "detection_id bigint",
}

_EXPORT = (
    "id bigint, {crop}, barcode_src string, page_filename_src string, bbox_xyxy_gen array<double>, width_gen bigint, height_gen bigint, "
    "pixel_count_mpx_gen double, detection_confidence_gen double, classification_gen string, classification_confidence_gen double, "
    "classification_probs_gen array<struct<label:string,prob:double>>, phash_gen string, embedding_gen array<double>, caption_exp string, "
    "caption_linear_prob_exp double, caption_lang_passed_exp string, caption_lang_detected_exp string, caption_chronam_thesauri_matches_exp {thesaurus}, "
    "orientation_correction_gen string, orientation_correction_confidence_gen double, orientation_correction_probs_gen string"
)
#: The record of a hub export (crop as bytes and path, thesaurus as JSON) and of an object-store export.
EXPORTS = {
    "hub": _EXPORT.format(crop="crop_gen struct<bytes:binary,path:string>", thesaurus="string"),
    "store": _EXPORT.format(crop="crop_gen binary", thesaurus="map<string,map<string,bigint>>"),
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES.get(table) or EXPORTS[table])
