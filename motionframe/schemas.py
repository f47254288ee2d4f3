"""Schemas of the tables that files hold."""

POINT = "struct<x:double,y:double,z:double>"
LANDMARK = "struct<x:double,y:double,z:double,visibility:double>"
FRAMES = f"video_id string, episode_id string, t int, ts double, body array<{POINT}>, body_conf array<double>, left_hand array<{POINT}>, right_hand array<{POINT}>, confidence double"
POSE_JSON = f"metadata struct<video_path:string,fps:double,total_frames:bigint,num_pose_frames:bigint>, frames array<struct<frame_idx:bigint,timestamp:double,pose_confidence:double,body_landmarks:array<{LANDMARK}>,left_hand:array<{POINT}>,right_hand:array<{POINT}>>>"
DETECTIONS_JSON = "video_path string, frames array<struct<frame_idx:bigint,timestamp:double,objects:array<struct<class_id:int,class_name:string,confidence:double,bbox:array<int>>>>>"
CANDIDATES = ["url", "video_id", "title", "platform", "keyword", "duration_sec", "view_count", "channel_name", "discovered_at"]
VIDEOS = "video_id string, platform string, url string, title string, description string, duration_sec bigint, channel_name string, view_count bigint, tags array<string>, status string, local_path string, discovered_at timestamp, downloaded_at timestamp"
JOBS = "job_key string, platform string, video_id string, processing_version string, status string, stage string, retry_count int, max_retries int, failure_type string, failure_reason string, created_at timestamp, started_at timestamp, completed_at timestamp"
MANIFEST = "version string, created_at timestamp, description string, files array<struct<key:string,sha256:string,size_bytes:bigint,file_type:string,storage_class:string,compression:string>>"
STAGE_CONTRACTS = {
    "candidate": "url string, video_id string, platform string, title string, keyword string, discovered_at timestamp, url_hash string",
    "download": "video_id string, platform string, local_path string, size_bytes bigint, sha256 string, downloaded_at timestamp",
    "feature": "video_id string, frames bigint, fps double, confidence double, feature_path string",
    "episode": "episode_id string, video_id string, start_frame bigint, end_frame bigint, confidence double, quality_score double",
    "processing": "job_key string, stage string, status string, result_path string, result_hash string, created_at timestamp",
}
CONTEXT = "platform string, video_id string, captured_at timestamp, params map<string,string>, versions map<string,string>"
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
