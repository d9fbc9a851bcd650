"""Explicit schemas of the stored tables. Codes are text and empty stays empty."""

from __future__ import annotations

CODES = "network string, station string, location string, channel string"
SENSOR = "struct<channels:string,sensitivity:double,input_units:string,output_units:string,frequency_hz:double>"

STATIONS = (
    "network string, station string, location string, channels string, latitude double, longitude double, elevation_m double, "
    f"sample_rate_hz double, model string, start_date date, end_date date, deployment string, instrument map<string,{SENSOR}>"
)
SEGMENTS = f"{CODES}, day date, start_ts timestamp, sampling_rate double, samples array<float>"
CHUNKS = f"{CODES}, start_time timestamp, end_time timestamp, status string, coverage double, attempted_at timestamp, error string"
PICKS = f"{CODES}, phase string, time timestamp, probability double, model string, amplitude double, amplitude_channel string"
DAY_EVENTS = (
    "event_index int, time timestamp, magnitude double, magnitude_type string, ml_err double, latitude double, longitude double, "
    "depth_km double, sigma_time double, sigma_amp double, num_picks int, num_ml_sta int"
)
ASSIGNMENTS = f"event_index int, {CODES}, phase string, time timestamp, probability double, amplitude double, amplitude_channel string"
REVIEWS = (
    "timestamp timestamp, source string, event_id string, "
    "event struct<event_id:string,time:string,magnitude:double,review_status:string,event_type:string>, "
    "picks array<struct<network:string,station:string,phase:string,time:string>>"
)
REGIONAL = "time timestamp, latitude double, longitude double, depth double, mag double, magType string, id string, place string, type string"
METRICS = "timestamp timestamp, step string"
