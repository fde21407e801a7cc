from .files import read_csv, write_csv
from .kafka import (console_writer, kafka_sink_options, kafka_source_options, kafka_writer,
                    read_kafka, start)
from .model_store import load_model, save_model
from .tables import (EM_FEATURES, EV_FEATURES, LI_FEATURES, embeddings_view, events_view,
                     labels_view, lineitem_view, table)
