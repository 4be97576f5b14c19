"""Batch sources (S1-S6, S12-S15). Streaming sources live in
:mod:`tidewater.streaming.sources`."""

from tidewater.sources.files import (
    convert, object_inventory, read_csv, read_json, read_json_folder, read_pixels, read_table, read_xml,
)
from tidewater.sources.catalog import read_jdbc, register_table

__all__ = ["read_csv", "read_json", "read_json_folder", "read_table", "object_inventory", "read_xml",
           "convert", "read_pixels", "read_jdbc", "register_table"]
