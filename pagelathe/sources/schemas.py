"""Declared schemas of everything that is read (DDL strings)."""

_ELEMENT = "struct<bbox_xyxy_norm:array<double>,label:int,label_name:string,score:double>"
_IMAGE = "image struct<path:string,height:int,width:int>"
_HEAD = "schema_version int, stage int, model string"
_TIMING = "timing struct<seconds:double>"

PAGE_ELEMENTS = f"{_HEAD}, {_IMAGE}, detections array<{_ELEMENT}>, {_TIMING}"
REGIONS = (
    f"{_HEAD}, {_IMAGE}, stage2_json string, regions array<struct<region_index:int,page_element:struct<bbox_xyxy_norm:array<double>,label:int,score:double>,"
    "detections:array<struct<bbox_xyxy_norm_in_region:array<double>,bbox_xyxy_norm_in_page:array<double>,label:int,score:double>>,raw_preds_present:boolean>>, "
    f"{_TIMING}"
)
OCR = (
    f"{_HEAD}, {_IMAGE}, stage2_json string, regions array<struct<source_model:string,bbox_xyxy_norm_in_page:array<double>,page_element:{_ELEMENT},detection:{_ELEMENT},"
    "source_json:string,ocr_raw:string,ocr_text:string>>, run struct<device:string,batch_size:int,resize_to_1024:boolean,ocr_endpoint:string,remote_batch_size:int>"
)
EMBEDDINGS = (
    f"{_HEAD}, image_path string, stage5_json string, pdfium_text_path string, texts array<string>, text_kinds array<string>, bboxes_xyxy_norm_in_page array<array<double>>, "
    f"embeddings array<array<float>>, {_TIMING}"
)
SKIPS = "image_path string, reason string, details string"
VECTORS = "vector array<float>, text string, metadata string, source string"
RECORDS = (
    "document_type string, metadata struct<content:string,embedding:array<float>,source_metadata:struct<source_name:string,source_id:string>,content_metadata:struct<page_number:int,subtype:string>,"
    "table_metadata:struct<table_content:string,table_location:array<double>,table_location_max_dimensions:array<int>>,"
    "image_metadata:struct<caption:string,text:string,image_location:array<double>,image_location_max_dimensions:array<int>>,audio_metadata:struct<audio_transcript:string>>"
)
METRICS = (
    "schema_version int, pdf_path string, pages_expected int, wall_s double, pages array<struct<page_index:int,counts:map<string,int>,timing_s:map<string,double>,"
    "models:map<string,struct<calls:int,seconds:double,items:int,batch_size_hist:map<string,int>>>,errors:array<string>,outputs:map<string,string>>>, "
    "totals struct<pages:int,models:map<string,struct<seconds:double,calls:double,items:double>>>"
)
CATALOG = "collection_name string, timestamp string, dense_index string, dense_dim int, sparse_index string, embedding_model string, sparse_model string, user_fields array<string>"
