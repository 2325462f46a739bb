"""Struct types shared by the typed time-series schemas, and the two input tables.

Unsigned integers take the next wider signed Spark type; nanosecond times stay in ``bigint``.
"""

from __future__ import annotations

TIME = "struct<sec:bigint,nanosec:bigint>"
HEADER = f"struct<seq:bigint,stamp:{TIME},frame_id:string>"
VEC2 = "struct<x:double,y:double>"

_MIXIN = f"header:{HEADER},covariance:array<double>,covariance_type:smallint"

VEC3 = f"struct<x:double,y:double,z:double,{_MIXIN}>"
POINT3 = VEC3
QUAT = f"struct<x:double,y:double,z:double,w:double,{_MIXIN}>"
POSE = f"struct<position:{POINT3},orientation:{QUAT},{_MIXIN}>"
VELOCITY = f"struct<linear:{VEC3},angular:{VEC3},{_MIXIN}>"
ACCEL = VELOCITY
XFORM = f"struct<translation:{VEC3},rotation:{QUAT},target_frame_id:string,{_MIXIN}>"
WRENCH = f"struct<force:{VEC3},torque:{VEC3},{_MIXIN}>"
GPS_STATUS = f"struct<status:tinyint,service:int,satellites:tinyint,hdop:double,vdop:double,header:{HEADER}>"
ROI = f"struct<offset:{VEC2},height:bigint,width:bigint,do_rectify:boolean,header:{HEADER}>"

MESSAGES = (
    "recording string, channel_id int, topic string, log_time_ns bigint, "
    "publish_time_ns bigint, sequence bigint, payload binary"
)
CHANNELS = (
    "recording string, channel_id int, topic string, encoding string, schema_id int, "
    "schema_name string, schema_encoding string, schema_data string"
)
